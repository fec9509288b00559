"""Job shapes (J-00 ... J-20) bound to the fixture tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import round_even, zfill
from ..operators import filters as Fl
from ..operators import joins as J
from ..operators.aggregates import wide_counts
from ..session import scratch_dir
from . import jobs
from . import sqlfrag as Q
from .bind_scalars import DIRTY_SQL, dirty_prices
from .explore import (explore_election, explore_indicator, explore_register,
                      profile_tables, share_consistency, share_report)
from .fixtures import T, nation_register, returnflag_counts
from .registry import register


@register("job02_unemployment_rate", """
WITH w AS (
  SELECT l_suppkey,
         CAST(nullif(count(*) FILTER (WHERE l_returnflag = 'A'), 0) AS DOUBLE) AS a,
         CAST(nullif(count(*) FILTER (WHERE l_returnflag = 'N'), 0) AS DOUBLE) AS n,
         CAST(nullif(count(*) FILTER (WHERE l_returnflag = 'R'), 0) AS DOUBLE) AS r
  FROM lineitem GROUP BY l_suppkey),
x AS (
  SELECT lpad(CAST(s.s_nationkey AS VARCHAR), 5, '0') AS code_insee, w.r AS part,
         CASE WHEN coalesce(w.a, w.n) IS NOT NULL THEN coalesce(w.a, 0) + coalesce(w.n, 0) END
           + w.r AS total
  FROM w JOIN supplier s ON s.s_suppkey = w.l_suppkey),
y AS (
  SELECT x.code_insee, nt.n_name AS localisation,
         CASE WHEN total > 0 THEN part / total * 100 END AS taux
  FROM x LEFT JOIN (SELECT lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS code_insee, n_name
                    FROM nation) nt USING (code_insee)
  WHERE nt.n_name IS NOT NULL)
SELECT code_insee, localisation, round_even(avg(taux) * 100, 0) / 100 AS taux,
       CAST(2022 AS INTEGER) AS annee
FROM y GROUP BY code_insee, localisation
""")
def j02_rate_by_nation(spark, d):
    """Minimum slice (J-02 shape): share of returned lines per supplier,
    suppliers as the several rows of a nation, mean per nation."""
    wide = returnflag_counts(spark, d)
    sup = T(spark, d, "supplier").select("s_suppkey", F.col("s_nationkey").cast("string").alias("CODGEO"))
    rows = wide.join(sup, wide.l_suppkey == sup.s_suppkey, "inner")
    source = {jobs.EMPLOYED[0]: "A", jobs.EMPLOYED[1]: "N", jobs.UNEMPLOYED[0]: "R"}
    sheet = rows.select("CODGEO", *[(F.col(source[c]) if c in source else F.lit(None)).cast("string").alias(c)
                                    for c in jobs.EMPLOYED + jobs.UNEMPLOYED])
    rates = jobs.unemployment_rate(sheet, nation_register(spark, d), 2022)
    return rates.withColumnRenamed("taux_chomage", "taux")


# --- J-00 register -----------------------------------------------------------
NB = " "


def _raw_register(spark, d):
    s = T(spark, d, "supplier")
    first = s.select(F.col("s_suppkey").cast("string").alias("COM"),
                     F.when(F.col("s_nationkey") != 0, F.concat(F.lit(" "), "s_name", F.lit(NB)))
                     .alias("LIBELLE"),
                     F.col("s_nationkey").cast("string").alias("DEP"), (F.col("s_suppkey") * 2).alias("ord"))
    copy = s.select(F.col("s_suppkey").cast("string").alias("COM"), F.lit("copy").alias("LIBELLE"),
                    F.col("s_nationkey").cast("string").alias("DEP"),
                    (F.col("s_suppkey") * 2 + 1).alias("ord"))
    return first.unionByName(copy)


@register("job00_register", f"""
WITH raw AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS COM,
         CASE WHEN s_nationkey <> 0 THEN ' ' || s_name || chr(160) END AS LIBELLE,
         CAST(s_nationkey AS VARCHAR) AS DEP, s_suppkey * 2 AS ord FROM supplier
  UNION ALL SELECT CAST(s_suppkey AS VARCHAR), 'copy', CAST(s_nationkey AS VARCHAR), s_suppkey * 2 + 1
  FROM supplier),
c AS (SELECT {Q.zfill("COM", 5)} AS code_insee, {Q.strip("coalesce(LIBELLE, 'inconnu')")} AS nom_commune,
             DEP AS code_departement,
             row_number() OVER (PARTITION BY {Q.zfill("COM", 5)} ORDER BY ord) AS rn
      FROM raw WHERE COM IS NOT NULL)
SELECT code_insee, nom_commune, code_departement FROM c WHERE rn = 1""")
def job00_register(spark, d):
    return jobs.commune_register(_raw_register(spark, d), order_col="ord")


def customer_register(spark, d):
    return T(spark, d, "customer").select(
        zfill(F.col("c_custkey").cast("string"), 5).alias("code_insee"),
        F.col("c_name").alias("nom_commune"))


CUSTOMER_REGISTER_SQL = f"(SELECT {Q.zfill('CAST(c_custkey AS VARCHAR)', 5)} AS code_insee, " \
                        "c_name AS localisation FROM customer)"


@register("job01_income", f"""
WITH raw AS (SELECT o_orderkey, ' ' || CAST(o_custkey AS VARCHAR) AS CODGEO, raw AS Q221 FROM {DIRTY_SQL}),
p AS (SELECT o_orderkey, {Q.zfill(Q.strip("CODGEO"), 5)} AS code_insee, {Q.parse_number("Q221")} AS v FROM raw),
j AS (SELECT p.*, r.localisation,
             row_number() OVER (PARTITION BY p.code_insee ORDER BY o_orderkey) AS rn
      FROM p JOIN {CUSTOMER_REGISTER_SQL} r USING (code_insee))
SELECT code_insee, localisation, {Q.round_even("v", 2)} AS revenu_median, CAST(2021 AS INTEGER) AS annee
FROM j WHERE rn = 1""")
def job01_income(spark, d):
    o = dirty_prices(spark, d)
    raw = o.select("o_orderkey", F.concat(F.lit(" "), F.col("o_custkey").cast("string")).alias("CODGEO"),
                   F.col("raw").alias("Q221"))
    return jobs.median_income(raw, customer_register(spark, d), 2021, order_col="o_orderkey")


@register("job01_audit", f"""
WITH raw AS (SELECT ' ' || CAST(o_custkey AS VARCHAR) AS CODGEO FROM {DIRTY_SQL}),
p AS (SELECT {Q.zfill(Q.strip("CODGEO"), 5)} AS code_insee FROM raw)
SELECT count(*) AS rows_before, count(*) AS rows_after, count(*) FILTER (WHERE r.code_insee IS NULL) AS unmatched
FROM p LEFT JOIN {CUSTOMER_REGISTER_SQL} r USING (code_insee)""")
def job01_audit(spark, d):
    """What the job's own run, while its table is written, counted of its join."""
    raw = dirty_prices(spark, d).select("o_orderkey", F.concat(F.lit(" "), F.col("o_custkey").cast("string")).alias("CODGEO"),
                                        F.col("raw").alias("Q221"))
    audit = J.ObservedJoin()
    jobs.median_income(raw, customer_register(spark, d), 2021, order_col="o_orderkey", audit=audit).write.parquet(scratch_dir(spark, "income"))
    return spark.createDataFrame([audit.counts()], "rows_before long, rows_after long, unmatched long")


def supplier_register(spark, d):
    return T(spark, d, "supplier").select(
        zfill(F.col("s_suppkey").cast("string"), 5).alias("code_insee"),
        F.col("s_name").alias("nom_commune"))


SUPPLIER_REGISTER_SQL = f"(SELECT {Q.zfill('CAST(s_suppkey AS VARCHAR)', 5)} AS code_insee, " \
                        "s_name AS localisation FROM supplier)"
COMBOS = ["AF", "AO", "NF", "NO", "RF", "RO"]
SOCIAL = {"agri": ["AF"], "cadres": ["NF", "NO"], "employes": ["RF"], "ouvriers": ["AO", "RO"]}


def flag_status_counts(spark, d):
    """Per supplier: counts of lines by (return flag, line status) as text
    cells — missing combinations stay NULL (the pivot leaves them empty)."""
    li = T(spark, d, "lineitem").select(
        zfill(F.col("l_suppkey").cast("string"), 5).alias("code_insee"),
        F.concat("l_returnflag", "l_linestatus").alias("combo"))
    wide = wide_counts(li, "code_insee", "combo", COMBOS)
    return wide.select("code_insee", *[F.col(c).cast("string").alias(c) for c in COMBOS])


FLAG_STATUS_SQL = "(SELECT " + Q.zfill("CAST(l_suppkey AS VARCHAR)", 5) + " AS code_insee, " + ", ".join(
    f"CAST(nullif(count(*) FILTER (WHERE l_returnflag || l_linestatus = '{c}'), 0) AS DOUBLE) AS {c}"
    for c in COMBOS) + " FROM lineitem GROUP BY 1)"


def _social_sql():
    totals = {g: Q.min_count_sum(cols) for g, cols in SOCIAL.items()}
    total = " + ".join(totals.values())
    cols = ", ".join(f"{Q.round_even(Q.share(t, total), 2)} AS pourcentage_{g}" for g, t in totals.items())
    return f"""
SELECT w.code_insee, r.localisation, {cols}, CAST(2022 AS INTEGER) AS annee
FROM {FLAG_STATUS_SQL} w LEFT JOIN {SUPPLIER_REGISTER_SQL} r USING (code_insee)"""


@register("job03_social", _social_sql())
def job03_social(spark, d):
    wide = flag_status_counts(spark, d)
    cells = {jobs.SOCIAL_GROUPS[g][i]: c for g, combos in SOCIAL.items() for i, c in enumerate(combos)}
    sheet = wide.select(F.col("code_insee").alias("CODGEO"),
                        *[(F.col(cells[c]) if c in cells else F.lit(None).cast("string")).alias(c)
                          for cols in jobs.SOCIAL_GROUPS.values() for c in cols])
    return jobs.social_categories(sheet, supplier_register(spark, d), 2022)


@register("job04_density", f"""
SELECT {Q.zfill("CAST(p_partkey AS VARCHAR)", 5)} AS code_insee, p_name AS localisation,
       CAST(p_size AS DOUBLE) AS population, p_retailprice AS superficie_km2,
       {Q.round_even("CAST(round(p_size * 100000 / p_retailprice) AS DOUBLE) / 1000", 2)} AS densite,
       CAST(2022 AS INTEGER) AS annee
FROM part""")
def job04_density(spark, d):
    p = T(spark, d, "part")
    raw = p.select(F.col("p_partkey").cast("string").alias("code_insee"),
                   F.col("p_size").cast("string").alias("population"),
                   F.col("p_retailprice").cast("string").alias("superficie_km2"),
                   (F.round(F.col("p_size") * 100000 / F.col("p_retailprice")).cast("long") / 1000)
                   .cast("string").alias("densite"))
    reg = p.select(zfill(F.col("p_partkey").cast("string"), 5).alias("code_insee"),
                   F.col("p_name").alias("nom_commune"))
    return jobs.density(raw, reg, 2022)


# quantities 1..50 as the twenty age bands: two and a half per band
_BAND_SQL = "CAST(floor((l_quantity - 1) * 2 / 5) AS INTEGER)"
_MALE, _FEMALE = "l_linestatus = 'F'", "l_linestatus <> 'F'"


def census_sheet(spark, d):
    """Suppliers as communes of a census sheet: code in two parts, a flag
    (off for every tenth), and lines per quantity band and line status."""
    li = T(spark, d, "lineitem").select(
        "l_suppkey", F.floor((F.col("l_quantity") - 1) * 2 / 5).cast("int").alias("b"), (F.col("l_linestatus") == "F").alias("m"))
    counts = [F.count_if((F.col("b") == i) & (F.col("m") == male)).cast("string").alias(c)
              for i, (_, m, f, _) in enumerate(jobs.age_layout()) for c, male in ((m, True), (f, False))]
    wide = li.groupBy("l_suppkey").agg(*counts)
    key = F.col("l_suppkey")
    return wide.select(F.floor(key / 1000).cast("string").alias("DR"), (key % 1000).cast("string").alias("CR"),
                       F.when(key % 10 == 0, "0").otherwise(" 1 ").alias("STABLE"),
                       *[c for _, m, f, _ in jobs.age_layout() for c in (m, f)])


def _demography_sql():
    qs = [f"q{b}" for b in range(20)]
    total, young, senior = Q.zero_sum(qs), Q.zero_sum(qs[:5]), Q.zero_sum(qs[13:])
    cases = " ".join(f"WHEN {Q.zero_sum(qs[:i + 1])} >= ({total}) / 2 THEN {5 * i + 2.5}" for i in range(20))
    median = f"(CASE WHEN {total} <> 0 THEN CASE {cases} END END)"
    counts = ", ".join(f"CAST(count(*) FILTER (WHERE {_BAND_SQL} = {b} AND ({_MALE})) + count(*) FILTER (WHERE {_BAND_SQL} = {b} "
                       f"AND ({_FEMALE})) AS DOUBLE) AS q{b}" for b in range(20))
    code = Q.zfill("CAST(l_suppkey // 1000 AS VARCHAR)", 2) + " || " + Q.zfill("CAST(l_suppkey % 1000 AS VARCHAR)", 3)
    return f"""
WITH w AS (SELECT {code} AS code_insee, {counts} FROM lineitem WHERE l_suppkey % 10 <> 0 GROUP BY l_suppkey),
i AS (SELECT code_insee, {Q.share(young, total)} AS pct_jeunes, {Q.share(senior, total)} AS pct_seniors,
             {median} AS age_median FROM w)
SELECT i.code_insee, r.localisation, {Q.round_even("pct_jeunes", 2)} AS pct_jeunes,
       {Q.round_even("pct_seniors", 2)} AS pct_seniors, {Q.round_even("age_median", 2)} AS age_median,
       CAST(2022 AS INTEGER) AS annee
FROM i LEFT JOIN {SUPPLIER_REGISTER_SQL} r USING (code_insee)
WHERE r.localisation IS NOT NULL AND pct_jeunes IS NOT NULL AND pct_seniors IS NOT NULL
  AND age_median IS NOT NULL AND {Q.strip("r.localisation")} <> ''"""


@register("job05_demography", _demography_sql())
def job05_demography(spark, d):
    return jobs.demography(census_sheet(spark, d), supplier_register(spark, d), 2022)


PREFIXED = {"AF": "INATC1_SEXE_AF", "AO": "INATC1_SEXE_AO", "NF": "INATC1_SEXE_NF",
            "NO": "INATC1_SEXE_NO", "RF": "INATC2_SEXE_RF", "RO": "INATC2_SEXE_RO"}


@register("job06_immigration", f"""
WITH w AS {FLAG_STATUS_SQL},
x AS (SELECT code_insee, {Q.zero_sum(["RF", "RO"])} AS part, {Q.zero_sum(["AF", "AO", "NF", "NO"])} AS other
      FROM w),
y AS (SELECT x.code_insee, r.localisation, {Q.share("part", "part + other")} AS taux
      FROM x LEFT JOIN {SUPPLIER_REGISTER_SQL} r USING (code_insee))
SELECT code_insee, localisation, {Q.round_even("taux", 2)} AS taux_immigration, CAST(2022 AS INTEGER) AS annee
FROM y WHERE localisation IS NOT NULL AND taux IS NOT NULL AND {Q.strip("localisation")} <> ''""")
def job06_immigration(spark, d):
    wide = flag_status_counts(spark, d)
    sheet = wide.select(F.col("code_insee").alias("CODGEO"), *[F.col(c).alias(n) for c, n in PREFIXED.items()])
    return jobs.immigration_rate(sheet, supplier_register(spark, d), 2022)


@register("job07_associations", f"""
WITH e AS (SELECT {Q.zfill("CAST(user_id AS VARCHAR)", 5)} AS code_insee, count(*) AS n FROM events GROUP BY 1)
SELECT e.code_insee, r.localisation, CAST(e.n AS DOUBLE) AS nb_associations, CAST(2022 AS INTEGER) AS annee
FROM e LEFT JOIN {CUSTOMER_REGISTER_SQL} r USING (code_insee)
WHERE r.localisation IS NOT NULL AND {Q.strip("r.localisation")} <> ''""")
def job07_associations(spark, d):
    e = T(spark, d, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    n = F.col("n").cast("string")
    # thousands rendered with an inner blank, as in the public file
    txt = F.when(F.length(n) > 3, F.concat(n.substr(F.lit(1), F.length(n) - 3), F.lit(" "),
                                           F.substring(n, -3, 3))).otherwise(n)
    raw = e.select(F.col("user_id").cast("string").alias("INSEE"), txt.alias("ASSO2022"))
    return jobs.associations(raw, customer_register(spark, d), 2022)


YEARS = list(range(1995, 2002))


@register("job08_business", f"""
WITH c AS (SELECT {Q.zfill("CAST(o_custkey AS VARCHAR)", 5)} AS code_insee, count(*) AS n
           FROM orders WHERE year(o_orderdate) = 1997 GROUP BY 1),
k AS (SELECT {Q.zfill("CAST(c_custkey AS VARCHAR)", 5)} AS code_insee FROM customer
      WHERE c_custkey IN (SELECT o_custkey FROM orders))
SELECT k.code_insee, r.localisation, CAST(coalesce(c.n, 0) AS BIGINT) AS nb_creations_entreprises,
       CAST(1997 AS INTEGER) AS annee
FROM k LEFT JOIN c USING (code_insee) LEFT JOIN {CUSTOMER_REGISTER_SQL} r USING (code_insee)
WHERE r.localisation IS NOT NULL""")
def job08_business(spark, d):
    o = T(spark, d, "orders").select("o_custkey", F.year("o_orderdate").alias("y"))
    wide = wide_counts(o, "o_custkey", "y", YEARS)
    cells = wide.select(F.lit("sheet").alias("file"), (F.col("o_custkey") + 4).alias("row_no"),
                        F.array(F.col("o_custkey").cast("string"), F.lit("name"),
                                *[F.col(str(y)).cast("string") for y in YEARS]).alias("cells"))
    titles = spark.range(4).select(F.lit("sheet").alias("file"), F.col("id").alias("row_no"),
                                   F.array(F.lit("Créations")).alias("cells"))
    return jobs.business_creations(titles.unionByName(cells), customer_register(spark, d), 1997,
                                   first_year=YEARS[0], last_year=YEARS[-1], skip=4)


# --- J-09 election -------------------------------------------------------------
PRIORITY_BLOCS = {"extreme_droite": ["P1"], "extreme_gauche": ["P2"], "centre": ["P3"],
                  "droite": ["P4"], "gauche": ["P5"]}
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def polling_stations(spark, d):
    """Orders as polling-station rows: commune = customer's nation, votes per
    'candidate' = price of the order under its priority, as text."""
    o = T(spark, d, "orders").select("o_custkey", "o_orderpriority", "o_totalprice")
    c = T(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    oc = o.join(c, "o_custkey")
    txt = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    cols = [F.when(F.col("o_orderpriority") == p, txt).alias(f"P{i + 1}") for i, p in enumerate(PRIORITIES)]
    return oc.select(F.col("c_nationkey").cast("string").alias("CodeInsee"), txt.alias("Exprimés"), *cols)


def _election_sql():
    sums = ", ".join(f"sum(CASE WHEN o_orderpriority = '{p}' THEN o_totalprice ELSE 0 END) AS P{i + 1}"
                     for i, p in enumerate(PRIORITIES))
    blocs = list(PRIORITY_BLOCS)
    arr = ", ".join(f"P{i + 1}" for i in range(5))
    winner = "CASE greatest(" + arr + ") " + " ".join(f"WHEN P{i + 1} THEN '{b}'" for i, b in enumerate(blocs)) + " END"
    scores = ", ".join(f"{Q.round_even(Q.share(f'P{i + 1}', 'expr'), 2)} AS score_{b}" for i, b in enumerate(blocs))
    return f"""
WITH s AS (SELECT {Q.zfill("CAST(c.c_nationkey AS VARCHAR)", 5)} AS code_insee, sum(o_totalprice) AS expr, {sums}
           FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1),
r AS (SELECT {Q.zfill("CAST(n_nationkey AS VARCHAR)", 5)} AS code_insee, n_name AS localisation FROM nation)
SELECT s.code_insee, {Q.remove_accents("r.localisation")} AS localisation, {winner} AS classe_politique, {scores},
       CAST(2022 AS INTEGER) AS annee
FROM s LEFT JOIN r USING (code_insee) WHERE r.localisation IS NOT NULL"""


@register("job09_election", _election_sql())
def job09_election(spark, d):
    return jobs.election_result(polling_stations(spark, d), nation_register(spark, d), 2022,
                                blocs=PRIORITY_BLOCS, bloc_order=list(PRIORITY_BLOCS))


@register("job10_register_difference", f"""
SELECT {Q.zfill("CAST(doc_id AS VARCHAR)", 5)} AS COM, lang, CAST(NULL AS INTEGER) AS quality,
       'removed' AS change FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
UNION ALL
SELECT {Q.zfill("CAST(doc_id AS VARCHAR)", 5)}, NULL, quality, 'added' FROM labels
WHERE doc_id NOT IN (SELECT doc_id FROM documents)""")
def job10_register_difference(spark, d):
    old = T(spark, d, "documents").select(F.col("doc_id").cast("string").alias("COM"), "lang")
    new = T(spark, d, "labels").select(F.col("doc_id").cast("string").alias("COM"), "quality")
    return jobs.register_difference(old, new, "COM")


def bridge_registers(spark, d):
    """Two register years from supplier. Names lose their last digit (about
    ten suppliers share one, a few also share the nation: bounded homonym
    fan-out); the new year writes them in lower case with a blank for '#',
    the old one with a hyphen. Nation 0 has no department on either side.
    Suppliers with a negative balance are merged into a per-nation parent."""
    s = T(spark, d, "supplier")
    prefix = F.col("s_name").substr(F.lit(1), F.length("s_name") - 1)
    dep = F.when(F.col("s_nationkey") != 0, F.col("s_nationkey").cast("string"))
    old = s.select(F.col("s_suppkey").cast("string").alias("COM"),
                   F.regexp_replace(prefix, "#", "-").alias("NCC"), dep.alias("DEP"))
    parent = F.when(F.col("s_acctbal") < 0, (F.col("s_nationkey") + 900000).cast("string"))
    new = s.select(F.col("s_suppkey").cast("string").alias("COM"),
                   F.lower(F.regexp_replace(prefix, "#", " ")).alias("NCC"), dep.alias("DEP"),
                   parent.alias("COMPARENT"),
                   F.when(parent.isNotNull(), "COMD").otherwise("COM").alias("TYPECOM"))
    return old, new


BRIDGE_SQL = f"""
old AS (SELECT CAST(s_suppkey AS VARCHAR) AS COM,
               {Q.normalize_place_name("replace(substr(s_name, 1, length(s_name) - 1), '#', '-')")} AS nom_clean,
               CASE WHEN s_nationkey <> 0 THEN CAST(s_nationkey AS VARCHAR) END AS DEP FROM supplier),
new AS (SELECT CAST(s_suppkey AS VARCHAR) AS COM,
               {Q.normalize_place_name("lower(replace(substr(s_name, 1, length(s_name) - 1), '#', ' '))")}
                 AS nom_clean,
               CASE WHEN s_nationkey <> 0 THEN CAST(s_nationkey AS VARCHAR) END AS DEP,
               CASE WHEN s_acctbal < 0 THEN CAST(s_nationkey + 900000 AS VARCHAR)
                    ELSE CAST(s_suppkey AS VARCHAR) END AS vrai,
               CASE WHEN s_acctbal < 0 THEN 'COMD' ELSE 'COM' END AS TYPECOM
        FROM supplier),
bridge AS (SELECT old.COM AS Code_INSEE_2022, new.vrai AS Code_INSEE_2024, old.nom_clean AS Nom_Commune,
                  new.TYPECOM AS Statut_2024
           FROM old JOIN new ON old.nom_clean IS NOT DISTINCT FROM new.nom_clean
                            AND old.DEP IS NOT DISTINCT FROM new.DEP)"""


@register("job11_code_bridge", f"WITH {BRIDGE_SQL} SELECT * FROM bridge")
def job11_code_bridge(spark, d):
    old, new = bridge_registers(spark, d)
    return jobs.code_bridge(old, new)


@register("job12_projected_income", f"""
WITH {BRIDGE_SQL},
m AS (SELECT b.Code_INSEE_2024, b.Nom_Commune,
             s.s_acctbal * (1.12 - 0.10 * (CAST(s.s_nationkey AS DOUBLE) / 25.0)) AS est
      FROM bridge b JOIN supplier s ON b.Code_INSEE_2022 = CAST(s.s_suppkey AS VARCHAR))
SELECT Code_INSEE_2024 AS code_insee, Nom_Commune AS localisation,
       {Q.round_even("avg(est)", 0)} AS revenu_estime_2024
FROM m GROUP BY Code_INSEE_2024, Nom_Commune""")
def job12_projected_income(spark, d):
    """Income = balance, unemployment = nation key, keyed by the old code."""
    old, new = bridge_registers(spark, d)
    bridge = jobs.code_bridge(old, new)
    s = T(spark, d, "supplier")
    income = s.select(F.col("s_suppkey").cast("string").alias("code_insee"),
                      F.col("s_acctbal").cast("string").alias("revenu_median"))
    unemp = s.select(F.col("s_suppkey").cast("string").alias("code_insee"),
                     F.col("s_nationkey").cast("string").alias("taux_chomage"))
    return jobs.projected_income(bridge, income, unemp)


# --- J-13 ... J-17 exploration ----------------------------------------------------
#: All columns of orders, and those that are numbers.
ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
ORDER_NUMBERS = ["o_orderkey", "o_custkey", "o_totalprice"]


def _profile_sql():
    parts = []
    for c in ORDER_COLS:
        exprs = {"missing": f"count(*) FILTER (WHERE {c} IS NULL)",
                 "missing_pct": Q.round_even(f"avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) * 100", 2)}
        if c in ORDER_NUMBERS:
            exprs |= {"count": f"count({c})", "mean": f"avg({c})", "std": f"stddev_samp({c})", "min": f"min({c})",
                      "25%": f"quantile_cont({c}, 0.25)", "50%": f"quantile_cont({c}, 0.5)",
                      "75%": f"quantile_cont({c}, 0.75)", "max": f"max({c})"}
        parts += [f"SELECT '{c}' AS column, '{s}' AS statistic, round(CAST({e} AS DOUBLE), 4) AS value FROM orders"
                  for s, e in exprs.items()]
    return " UNION ALL ".join(parts)


def _order_profile(spark, d, name):
    return profile_tables(T(spark, d, "orders").select(*ORDER_COLS), ORDER_NUMBERS)[name]()


@register("job13_profile", _profile_sql())
def job13_profile(spark, d):
    return _order_profile(spark, d, "statistics").withColumn("value", F.round("value", 4))


@register("job13_rows", "SELECT count(*) AS n FROM orders")
def job13_rows(spark, d):
    rows = _order_profile(spark, d, "rows")
    return rows.select(F.col(rows.columns[0]).alias("n"))


@register("job13_histograms", " UNION ALL ".join(f"""
SELECT * FROM (
WITH v AS (SELECT CAST({c} AS DOUBLE) AS x FROM orders), r AS (SELECT min(x) AS lo, max(x) AS hi FROM v),
c AS (SELECT CAST(least(floor((x - lo) * 50 / (hi - lo)) + 1, 50) AS INTEGER) AS bin, count(*) AS count FROM v, r GROUP BY 1),
b AS (SELECT CAST(range AS INTEGER) AS bin FROM range(1, 51))
SELECT '{c}' AS column, b.bin, lo + (b.bin - 1) * ((hi - lo) / 50) AS lo, lo + b.bin * ((hi - lo) / 50) AS hi,
       coalesce(c.count, 0) AS count FROM b CROSS JOIN r LEFT JOIN c USING (bin))""" for c in ORDER_NUMBERS))
def job13_histograms(spark, d):
    return _order_profile(spark, d, "histograms")


@register("job14_share_check", f"""
WITH s AS ({_social_sql()}),
t AS (SELECT *, {Q.min_count_sum(["pourcentage_agri", "pourcentage_cadres", "pourcentage_employes",
                                  "pourcentage_ouvriers"])} AS total FROM s)
SELECT count(*) FILTER (WHERE total > 100.5) AS n_above, count(*) FILTER (WHERE total < 99.5) AS n_below,
       count(*) FILTER (WHERE pourcentage_agri IS NULL OR pourcentage_cadres IS NULL
                           OR pourcentage_employes IS NULL OR pourcentage_ouvriers IS NULL) AS n_missing
FROM t""")
def job14_share_check(spark, d):
    return share_consistency(job03_social(spark, d), [f"pourcentage_{g}" for g in SOCIAL])


@register("job15_explore_kpis", """
SELECT round(avg(value), 6) AS mean, min(value) AS min, max(value) AS max,
       CAST(trunc(avg(value)) AS BIGINT) AS mean_int FROM events WHERE event_type = 'purchase'""")
def job15_explore_kpis(spark, d):
    r = explore_indicator(T(spark, d, "events"), "value", "event_id", {"event_type": "purchase"})
    return r["kpis"].withColumn("mean", F.round("mean", 6))


@register("job15_explore_top", """
(SELECT 'top' AS side, event_id, value FROM events WHERE event_type = 'purchase'
 ORDER BY value DESC, event_id LIMIT 10)
UNION ALL
(SELECT 'bottom', event_id, value FROM events WHERE event_type = 'purchase' ORDER BY value, event_id LIMIT 10)""")
def job15_explore_top(spark, d):
    ev = T(spark, d, "events").select("event_id", "event_type", "value")
    r = explore_indicator(ev, "value", "event_id", {"event_type": "purchase"})
    return r["top"].select(F.lit("top").alias("side"), "event_id", "value").unionByName(
        r["bottom"].select(F.lit("bottom").alias("side"), "event_id", "value"))


@register("job15_explore_histogram", """
WITH e AS (SELECT value FROM events WHERE event_type = 'purchase'),
r AS (SELECT min(value) AS lo, max(value) AS hi FROM e),
c AS (SELECT CAST(least(floor((value - lo) * 30 / (hi - lo)) + 1, 30) AS INTEGER) AS bin, count(*) AS count
      FROM e, r GROUP BY 1),
b AS (SELECT CAST(range AS INTEGER) AS bin FROM range(1, 31))
SELECT b.bin, lo + (b.bin - 1) * ((hi - lo) / 30) AS lo, lo + b.bin * ((hi - lo) / 30) AS hi,
       coalesce(c.count, 0) AS count FROM b CROSS JOIN r LEFT JOIN c USING (bin)""")
def job15_explore_histogram(spark, d):
    return explore_indicator(T(spark, d, "events"), "value", "event_id", {"event_type": "purchase"})["histogram"]


@register("job16_explore_register", """
SELECT count(*) AS n_rows, count(DISTINCT p_name) AS n_distinct FROM part
WHERE p_type = 'SMALL' AND coalesce(regexp_matches(p_name, '(?i)ring|gear'), false)""")
def job16_explore_register(spark, d):
    return explore_register(T(spark, d, "part"), "p_name", "ring|gear", {"p_type": "SMALL"})["counts"]


@register("job17_explore_election", f"""
WITH e AS ({_election_sql()})
SELECT count(*) AS n_rows,
       (SELECT classe_politique FROM e GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS dominant,
       round(avg(greatest(score_extreme_droite, score_extreme_gauche, score_centre, score_droite, score_gauche)), 4)
         AS mean_winning_score
FROM e""")
def job17_explore_election(spark, d):
    e = job09_election(spark, d)
    r = explore_election(e, "classe_politique", [f"score_{b}" for b in PRIORITY_BLOCS])
    return r["kpi"].withColumn("mean_winning_score", F.round("mean_winning_score", 4))


@register("job17_bloc_distribution", f"""
WITH e AS ({_election_sql()}) SELECT classe_politique, count(*) AS count FROM e GROUP BY 1""")
def job17_bloc_distribution(spark, d):
    e = job09_election(spark, d)
    return explore_election(e, "classe_politique", [f"score_{b}" for b in PRIORITY_BLOCS])["distribution"]


@register("job17_mean_scores", f"""
WITH e AS ({_election_sql()})
""" + " UNION ALL ".join(f"SELECT 'score_{b}' AS column, round(avg(score_{b}), 4) AS mean FROM e" for b in PRIORITY_BLOCS))
def job17_mean_scores(spark, d):
    r = explore_election(job09_election(spark, d), "classe_politique", [f"score_{b}" for b in PRIORITY_BLOCS])
    return r["mean_scores"].withColumn("mean", F.round("mean", 4))


@register("job16_register_rows", """
SELECT p_partkey, p_name FROM part
WHERE p_type = 'SMALL' AND coalesce(regexp_matches(p_name, '(?i)ring|gear'), false)""")
def job16_register_rows(spark, d):
    return explore_register(T(spark, d, "part"), "p_name", "ring|gear", {"p_type": "SMALL"})["rows"].select("p_partkey", "p_name")


_SHARES = [f"pourcentage_{g}" for g in SOCIAL]


@register("job14_sum_describe", f"""
WITH s AS ({_social_sql()}), t AS (SELECT {Q.min_count_sum(_SHARES)} AS total FROM s)
SELECT 'total' AS column, u.statistic, round(u.value, 4) AS value FROM (
  SELECT unnest(['count', 'mean', 'std', 'min', '25%', '50%', '75%', 'max']) AS statistic,
         unnest([CAST(count(total) AS DOUBLE), avg(total), stddev_samp(total), min(total), quantile_cont(total, 0.25),
                 quantile_cont(total, 0.5), quantile_cont(total, 0.75), max(total)]) AS value FROM t) u""")
def job14_sum_describe(spark, d):
    return share_report(job03_social(spark, d), _SHARES, "code_insee")["sum"].withColumn("value", F.round("value", 4))


@register("job14_incomplete_rows", f"""
SELECT code_insee, localisation FROM ({_social_sql()})
WHERE {" OR ".join(f"{c} IS NULL" for c in _SHARES)} ORDER BY code_insee LIMIT 20""")
def job14_incomplete_rows(spark, d):
    return share_report(job03_social(spark, d), _SHARES, "code_insee")["incomplete"].select("code_insee", "localisation")


@register("job13_patterns", """
SELECT doc_id IS NULL AS doc_id, quality IS NULL AS quality, toxic IS NULL AS toxic, count(*) AS count FROM labels GROUP BY ALL""")
def job13_patterns(spark, d):
    return profile_tables(T(spark, d, "labels"), ["quality", "toxic"])["patterns"]()


def _boxes_sql(cols):
    return " UNION ALL ".join(f"""
SELECT '{c}' AS column, q1, med AS median, q3, q3 - q1 AS iqr,
       min({c}) FILTER (WHERE {c} >= q1 - 1.5 * (q3 - q1)) AS lower_whisker,
       max({c}) FILTER (WHERE {c} <= q3 + 1.5 * (q3 - q1)) AS upper_whisker,
       count(*) FILTER (WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS n_outliers
FROM (SELECT CAST({c} AS DOUBLE) AS {c} FROM orders), (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1,
     quantile_cont(CAST({c} AS DOUBLE), 0.5) AS med, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3 FROM orders)
GROUP BY q1, med, q3""" for c in cols)


@register("job13_boxes", _boxes_sql(ORDER_NUMBERS))
def job13_boxes(spark, d):
    return _order_profile(spark, d, "boxes")
