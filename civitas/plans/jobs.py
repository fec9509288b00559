"""Indicator jobs (J-00 ... J-12): raw open-data tables -> typed indicator
tables keyed by commune code and year.

Each job is ``job(raw DataFrame(s), register, year) -> DataFrame`` built
only from the operator library; nothing is computed until the caller
writes or collects. Whether the commune register is broadcast is left to
its size at run time. Per-commune aggregations use partial aggregation, so a code
carrying a third of the rows does not end up in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import (argmax_label, as_int, coerce_number, fill_missing, normalize_place_name,
                                 parse_number, remove_accents, remove_all_whitespace, round_even,
                                 row_sum_min_count, row_sum_zero, share, strip, zfill)
from ..operators import aggregates as G
from ..operators import columns as P
from ..operators import filters as Fl
from ..operators import joins as J
from ..sources.readers import skip_and_name

CODE_WIDTH = 5

# ---------------------------------------------------------------------------
# Source column names and groupings of the public files.
REGISTER_COLUMNS = {"COM": "code_insee", "LIBELLE": "nom_commune", "DEP": "code_departement",
                    "REG": "code_region"}
UNKNOWN_NAME = "inconnu"
EMPLOYED = ["INATC1_SEXE1_TACTR11", "INATC1_SEXE2_TACTR11", "INATC2_SEXE1_TACTR11",
            "INATC2_SEXE2_TACTR11"]
UNEMPLOYED = ["INATC1_SEXE1_TACTR12", "INATC1_SEXE2_TACTR12", "INATC2_SEXE1_TACTR12",
              "INATC2_SEXE2_TACTR12"]
SOCIAL_GROUPS = {
    "agri": ["C22_POP1524_STAT_GSEC11_21", "C22_POP2554_STAT_GSEC11_21", "C22_POP55P_STAT_GSEC11_21"],
    "cadres": ["C22_POP1524_STAT_GSEC13_23", "C22_POP2554_STAT_GSEC13_23", "C22_POP55P_STAT_GSEC13_23"],
    "employes": ["C22_POP1524_STAT_GSEC15_25", "C22_POP2554_STAT_GSEC15_25", "C22_POP55P_STAT_GSEC15_25"],
    "ouvriers": ["C22_POP1524_STAT_GSEC16_26", "C22_POP2554_STAT_GSEC16_26", "C22_POP55P_STAT_GSEC16_26"],
}
AGE_BANDS = 20  # ageq_rec01 .. ageq_rec20, midpoints 2.5 .. 97.5 step 5
YOUNG_BANDS = 5  # 0-24
SENIOR_FIRST_BAND = 14  # 65+
CANDIDATE_BLOCS = {
    "extreme_droite": ["LE PEN.exp", "ZEMMOUR.exp"],
    "extreme_gauche": ["MÉLENCHON.exp", "ARTHAUD.exp", "POUTOU.exp"],
    "centre": ["MACRON.exp", "LASSALLE.exp"],
    "droite": ["PÉCRESSE.exp", "DUPONT-AIGNAN.exp"],
    "gauche": ["ROUSSEL.exp", "HIDALGO.exp", "JADOT.exp"],
}
EXPRESSED = "Exprimés"
BLOC_ORDER = ["extreme_droite", "extreme_gauche", "centre", "droite", "gauche"]
MERGED_STATUS = "COMD"
PROJECTION_BASE, PROJECTION_ALPHA, PROJECTION_NORM = 1.12, 0.10, 25.0
# ---------------------------------------------------------------------------


def age_layout():
    """(band, male column, female column, midpoint) for the 20 age bands."""
    return [(f"b{i:02d}", f"ageq_rec{i:02d}s1rpop2022", f"ageq_rec{i:02d}s2rpop2022", 2.5 + 5 * (i - 1))
            for i in range(1, AGE_BANDS + 1)]


def file_order():
    """Order of rows as read: files by name, then place in the file (Spark
    packs splits into tasks by size, so the task's order is not the file's)."""
    return F.struct(F.input_file_name().alias("file"), F.input_file_block_start().alias("block"),
                    F.monotonically_increasing_id().alias("row"))


def _register_names(register: DataFrame) -> DataFrame:
    return register.select(zfill("code_insee", CODE_WIDTH).alias("code_insee"),
                           F.col("nom_commune").alias("localisation"))


def commune_register(raw: DataFrame, order_col: str | None = None) -> DataFrame:
    """J-00: register from the raw commune file (columns may be absent)."""
    df = raw if order_col else raw.withColumn("__order", file_order())
    order_col = order_col or "__order"
    present = {k: v for k, v in REGISTER_COLUMNS.items() if k in df.columns}
    sel = df.select(*[F.col(k).alias(v) for k, v in present.items()], order_col)
    sel = Fl.drop_missing(sel, ["code_insee"])
    if "nom_commune" in sel.columns:
        sel = sel.withColumn("nom_commune", strip(fill_missing("nom_commune", UNKNOWN_NAME)))
    sel = sel.withColumn("code_insee", zfill("code_insee", CODE_WIDTH))
    first = G.first_per_key(sel, "code_insee", [order_col])
    return first.select(*present.values())


def median_income(raw: DataFrame, register: DataFrame, year: int,
                  code_col: str = "CODGEO", value_col: str = "Q221",
                  order_col: str | None = None, audit: J.ObservedJoin | None = None) -> DataFrame:
    """J-01: median income per commune (secret values ``s`` become NULL);
    the first row of a duplicated code (file order) is kept. ``audit`` counts
    the join to the register while the job runs."""
    df = P.normalize_column_names(raw, "\"'")
    P.require_columns(df, [code_col, value_col])
    order = F.col(order_col) if order_col else file_order()
    df = df.select(zfill(strip(F.col(code_col)), CODE_WIDTH).alias("code_insee"),
                   parse_number(value_col).alias("revenu_median"), order.alias("__order"))
    enrich = audit.enrich_strict if audit else J.enrich_strict
    joined = enrich(df, _register_names(register), "code_insee", "localisation")
    first = G.first_per_key(joined, "code_insee", ["__order"])
    return first.select("code_insee", "localisation",
                        round_even("revenu_median", 2).alias("revenu_median"),
                        F.lit(year).cast("int").alias("annee"))


def rate_indicator(df: DataFrame, register: DataFrame, part_cols, other_cols, name: str,
                   year: int, code_col: str = "code_insee") -> DataFrame:
    """Core of J-02: rate = part / (part + other) * 100 per row (sums with
    ``min_count=1``, guarded division), left join to the register, drop
    unmatched, mean per (code, name), round half-even."""
    parsed = df.select(F.col(code_col).alias("code_insee"),
                       *[F.col(c).cast("double").alias(c) for c in [*part_cols, *other_cols]])
    part = row_sum_min_count(part_cols)
    total = row_sum_min_count(other_cols) + part
    rates = parsed.select("code_insee", share(part, total).alias(name))
    joined = J.enrich_strict(rates, _register_names(register), "code_insee", "localisation")
    mean = G.group_mean(joined, ["code_insee", "localisation"], name)
    return mean.select("code_insee", "localisation", round_even(name, 2).alias(name),
                       F.lit(year).cast("int").alias("annee"))


def unemployment_rate(sheet: DataFrame, register: DataFrame, year: int) -> DataFrame:
    """J-02 from a header-promoted sheet (see ``sources.promote_header``)."""
    df = P.normalize_column_names(sheet, "\n ")
    P.require_columns(df, ["CODGEO", *EMPLOYED, *UNEMPLOYED])
    parsed = df.select(zfill("CODGEO", CODE_WIDTH).alias("code_insee"),
                       *[parse_number(c).alias(c) for c in EMPLOYED + UNEMPLOYED])
    return rate_indicator(parsed, register, UNEMPLOYED, EMPLOYED, "taux_chomage", year)


def group_shares(df: DataFrame, groups: dict[str, list[str]], prefix: str = "pourcentage_"):
    """Core of J-03: per-group totals (``min_count=1``), their plain sum as
    the total, guarded percentage of each group."""
    totals = {g: row_sum_min_count(cols) for g, cols in groups.items()}
    total = None
    for t in totals.values():
        total = t if total is None else total + t
    return [share(t, total).alias(prefix + g) for g, t in totals.items()]


def social_categories(sheet: DataFrame, register: DataFrame, year: int) -> DataFrame:
    """J-03: share of four social categories among the active population."""
    df = P.normalize_column_names(sheet, "\n \"'")
    cols = [c for g in SOCIAL_GROUPS.values() for c in g]
    P.require_columns(df, ["CODGEO", *cols])
    parsed = df.select(zfill("CODGEO", CODE_WIDTH).alias("code_insee"),
                       *[coerce_number(c).alias(c) for c in cols])
    shares = parsed.select("code_insee", *group_shares(parsed, SOCIAL_GROUPS))
    joined = J.enrich(shares, _register_names(register), "code_insee")
    out = [round_even(f"pourcentage_{g}", 2).alias(f"pourcentage_{g}") for g in SOCIAL_GROUPS]
    return joined.select("code_insee", "localisation", *out, F.lit(year).cast("int").alias("annee"))


def density(raw: DataFrame, register: DataFrame, year: int) -> DataFrame:
    """J-04: population, area and density per commune."""
    P.require_columns(raw, ["code_insee", "population", "superficie_km2", "densite"])
    df = raw.select(zfill("code_insee", CODE_WIDTH).alias("code_insee"),
                    *[coerce_number(c).alias(c) for c in ("population", "superficie_km2", "densite")])
    joined = J.enrich(df, _register_names(register), "code_insee")
    return joined.select("code_insee", "localisation", "population", "superficie_km2",
                         round_even("densite", 2).alias("densite"),
                         F.lit(year).cast("int").alias("annee"))


def age_indicators(df: DataFrame, counts, midpoints, young: int, senior_from: int):
    """Core of J-05 on per-band counts: shares of young and seniors and the
    banded median age (G25), all as native expressions."""
    cs = [F.coalesce(F.col(c), F.lit(0.0)) if isinstance(c, str) else c for c in counts]
    total = row_sum_zero(cs)
    young_n = row_sum_zero(cs[:young])
    senior_n = row_sum_zero(cs[senior_from:])
    return [share(young_n, total).alias("pct_jeunes"), share(senior_n, total).alias("pct_seniors"),
            G.banded_median_expr(cs, midpoints).alias("age_median")]


def demography(sheet: DataFrame, register: DataFrame, year: int) -> DataFrame:
    """J-05: pct young (<25), pct seniors (65+), banded median age."""
    df = P.normalize_column_names(sheet, "")
    layout = age_layout()
    P.require_columns(df, ["DR", "CR", "STABLE", *[c for _, m, f, _ in layout for c in (m, f)]])
    df = P.compose_key(df, "code_insee", ["DR", "CR"], [2, 3])
    df = Fl.filter_flag(df, "STABLE", "1")
    bands = [(F.coalesce(coerce_number(m), F.lit(0.0)) + F.coalesce(coerce_number(f), F.lit(0.0)))
             for _, m, f, _ in layout]
    ind = df.select("code_insee", *age_indicators(df, bands, [mid for *_, mid in layout],
                                                   YOUNG_BANDS, SENIOR_FIRST_BAND - 1))
    joined = J.enrich(ind, _register_names(register), "code_insee")
    kept = Fl.drop_blank(Fl.drop_missing(joined, ["localisation", "pct_jeunes", "pct_seniors",
                                                  "age_median"]), "localisation")
    return kept.select("code_insee", "localisation",
                       *[round_even(c, 2).alias(c) for c in ("pct_jeunes", "pct_seniors", "age_median")],
                       F.lit(year).cast("int").alias("annee"))


def prefix_rate(df: DataFrame, register: DataFrame, part_prefixes, other_prefixes, name: str,
                year: int, code_col: str = "code_insee") -> DataFrame:
    """Core of J-06: measures chosen by name prefix, missing = 0, guarded
    share of the ``part`` group, strict join, blank names removed."""
    part_cols = P.columns_with_prefix(df, part_prefixes)
    other_cols = P.columns_with_prefix(df, other_prefixes)
    part = row_sum_zero([F.col(c).cast("double") for c in part_cols])
    other = row_sum_zero([F.col(c).cast("double") for c in other_cols])
    rates = df.select(F.col(code_col).alias("code_insee"), share(part, part + other).alias(name))
    joined = J.enrich_strict(rates, _register_names(register), "code_insee", "localisation")
    kept = Fl.drop_blank(Fl.drop_missing(joined, ["localisation", name]), "localisation")
    return kept.select("code_insee", "localisation", round_even(name, 2).alias(name),
                       F.lit(year).cast("int").alias("annee"))


def immigration_rate(sheet: DataFrame, register: DataFrame, year: int) -> DataFrame:
    """J-06: share of foreign nationals (columns by prefix)."""
    df = P.normalize_column_names(sheet, "\n ")
    P.require_columns(df, ["CODGEO"])
    measures = P.columns_with_prefix(df, ["INATC1_SEXE", "INATC2_SEXE"])
    parsed = df.select(zfill("CODGEO", CODE_WIDTH).alias("code_insee"),
                       *[parse_number(c).alias(c) for c in measures])
    return prefix_rate(parsed, register, ["INATC2_SEXE"], ["INATC1_SEXE"], "taux_immigration", year)


def associations(sheet: DataFrame, register: DataFrame, year: int) -> DataFrame:
    """J-07: number of associations per commune."""
    df = P.normalize_column_names(sheet, "")
    df = P.select_rename(df, {"INSEE": "code_insee", "ASSO2022": "nb_associations"})
    parsed = df.select(zfill("code_insee", CODE_WIDTH).alias("code_insee"),
                       coerce_number(remove_all_whitespace("nb_associations")).alias("nb_associations"))
    joined = J.enrich(parsed, _register_names(register), "code_insee")
    kept = Fl.drop_blank(Fl.drop_missing(joined, ["localisation", "nb_associations"]), "localisation")
    return kept.select("code_insee", "localisation", "nb_associations",
                       F.lit(year).cast("int").alias("annee"))


def business_creations(cells: DataFrame, register: DataFrame, year: int,
                       first_year: int = 2012, last_year: int = 2025, skip: int = 4) -> DataFrame:
    """J-08: creations of the chosen year from a header-less sheet."""
    names = ["code_insee", "nom_brut", *[str(y) for y in range(first_year, last_year + 1)]]
    df = skip_and_name(cells, skip, names)
    P.require_columns(df, [str(year)])
    parsed = df.select(zfill("code_insee", CODE_WIDTH).alias("code_insee"),
                       fill_missing(coerce_number(str(year)), 0.0).alias("n"))
    joined = J.enrich(parsed, _register_names(register), "code_insee")
    kept = Fl.drop_blank(Fl.drop_missing(joined, ["localisation"]), "localisation")
    return kept.select("code_insee", "localisation",
                       as_int("n").alias("nb_creations_entreprises"),
                       F.lit(year).cast("int").alias("annee"))


def bloc_scores(sums: DataFrame, blocs: dict[str, list[str]], total_col: str, order) -> list:
    """Core of J-09 after the per-commune sums: bloc totals, winning bloc
    (first on ties), score of each bloc in % of the total."""
    totals = {b: row_sum_zero(cols) for b, cols in blocs.items()}
    winner = argmax_label([totals[b] for b in order], order).alias("classe_politique")
    scores = [round_even(share(totals[b], F.col(total_col)), 2).alias(f"score_{b}") for b in order]
    return [winner, *scores]


def election_result(stations: DataFrame, register: DataFrame, year: int,
                    blocs: dict | None = None, expressed: str = EXPRESSED,
                    bloc_order=None) -> DataFrame:
    """J-09: winning political bloc per commune from polling-station rows
    (summed per commune, missing = 0), scores in % of expressed votes."""
    blocs = blocs or CANDIDATE_BLOCS
    bloc_order = list(bloc_order or BLOC_ORDER)
    df = P.normalize_column_names(stations, "")
    df = df.withColumnRenamed("CodeInsee", "code_insee")
    candidates = [c for cols in blocs.values() for c in cols]
    measures = [expressed, *candidates]
    P.require_columns(df, ["code_insee", *measures])
    clean = {m: f"m{i}" for i, m in enumerate(measures)}
    parsed = df.select(zfill("code_insee", CODE_WIDTH).alias("code_insee"),
                       *[fill_missing(parse_number(F.col(f"`{m}`")), 0.0).alias(clean[m])
                         for m in measures])
    sums = G.group_sums(parsed, "code_insee", list(clean.values()))
    cblocs = {b: [clean[c] for c in cols] for b, cols in blocs.items()}
    scored = sums.select("code_insee", *bloc_scores(sums, cblocs, clean[expressed], bloc_order))
    joined = J.enrich(scored, _register_names(register), "code_insee")
    named = joined.withColumn("localisation", remove_accents("localisation"))
    kept = Fl.drop_blank(Fl.drop_missing(named, ["localisation", "classe_politique"]), "localisation")
    return kept.select("code_insee", "localisation", "classe_politique",
                       *[f"score_{b}" for b in bloc_order], F.lit(year).cast("int").alias("annee"))


def register_difference(old: DataFrame, new: DataFrame, key: str = "COM") -> DataFrame:
    """J-10: communes removed / added between two registers (tagged rows)."""
    o = old.withColumn(key, zfill(key, CODE_WIDTH))
    n = new.withColumn(key, zfill(key, CODE_WIDTH))
    return J.added_removed(o, n, key)


def code_bridge(reg_old: DataFrame, reg_new: DataFrame) -> DataFrame:
    """J-11: bridge of commune codes between register years.

    Merged communes (non-empty parent code) take the parent's code; rows
    are paired on (normalised name, department) with missing = missing
    (pandas ``merge``); duplicated names fan out.
    """
    new = reg_new.withColumn("COMPARENT", fill_missing("COMPARENT", ""))
    new = new.withColumn("code_actuel", F.when(F.col("COMPARENT") != "", F.col("COMPARENT"))
                         .otherwise(F.col("COM")))
    o = reg_old.select(F.col("COM"), normalize_place_name("NCC").alias("nom_norme"), "DEP")
    n = new.select(F.col("COM"), normalize_place_name("NCC").alias("nom_norme"), "DEP",
                   "code_actuel", "TYPECOM")
    pairs = J.null_safe_join(o, n, ["nom_norme", "DEP"], suffixes=("_2022", "_2024"))
    return pairs.select(F.col("COM_2022").alias("Code_INSEE_2022"),
                        F.col("code_actuel").alias("Code_INSEE_2024"),
                        F.col("nom_norme").alias("Nom_Commune"),
                        F.col("TYPECOM").alias("Statut_2024"))


def projected_income(bridge: DataFrame, income: DataFrame, unemployment: DataFrame,
                     base: float = PROJECTION_BASE, alpha: float = PROJECTION_ALPHA,
                     norm: float = PROJECTION_NORM) -> DataFrame:
    """J-12: income projected to the new code year:
    ``revenu * (base - alpha * chomage / norm)``, averaged over the old
    communes merged into one new code, rounded to units (half-even)."""
    rev = income.select(F.col("code_insee"), coerce_number("revenu_median").alias("revenu_median"))
    chom = unemployment.select("code_insee", coerce_number("taux_chomage").alias("taux_chomage"))
    m = J.join_on_pair(bridge, rev, "Code_INSEE_2022", "code_insee", keep="right")
    m = J.join_on_key(m, chom, "code_insee", ["taux_chomage"])
    est = m.withColumn("revenu_estime_2024", F.col("revenu_median") *
                       (F.lit(base) - F.lit(alpha) * (F.col("taux_chomage") / F.lit(norm))))
    mean = G.group_mean(est, ["Code_INSEE_2024", "Nom_Commune"], "revenu_estime_2024")
    return mean.select(F.col("Code_INSEE_2024").alias("code_insee"),
                       F.col("Nom_Commune").alias("localisation"),
                       round_even("revenu_estime_2024", 0).alias("revenu_estime_2024"))
