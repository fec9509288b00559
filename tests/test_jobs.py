"""Indicator jobs on tiny hand-written inputs with the public files' column
names and the probe rows (padding, 2A004, missing/unknown/duplicated codes,
secret values, French number formatting, zero totals, ties, accents)."""

import pytest
from pyspark.sql import functions as F

from civitas.plans import jobs
from civitas.sources import readers as S

NB, NNB = " ", " "


@pytest.fixture()
def register(spark):
    raw = spark.createDataFrame([
        ("1001", "L'Abergement", "01", "84"), ("2A004", "Ajaccio", "2A", "94"),
        ("1001", "Doublon", "01", "84"), (None, "Sans code", "01", "84"),
        ("75056", None, "75", "11"), ("13055", " Marseille ", "13", "93")],
        "COM string, LIBELLE string, DEP string, REG string")
    return jobs.commune_register(raw)


def test_register(register):
    rows = {r["code_insee"]: r["nom_commune"] for r in register.collect()}
    assert rows == {"01001": "L'Abergement", "2A004": "Ajaccio", "75056": "inconnu", "13055": "Marseille"}


def test_register_lenient_columns(spark):
    raw = spark.createDataFrame([("1", "A")], "COM string, LIBELLE string")
    assert jobs.commune_register(raw).columns == ["code_insee", "nom_commune"]


def test_median_income(spark, register):
    raw = spark.createDataFrame([
        ("1001", f"21{NNB}345,5{NB}"), ("2A004", "s"), ("99999", "100"), ("1001", "1"), (None, "5"),
        ("13055", "")], '`"CODGEO"` string, `Q221` string')
    out = {r["code_insee"]: r["revenu_median"] for r in jobs.median_income(raw, register, 2021).collect()}
    assert out == {"01001": 21345.5, "2A004": None, "13055": None}


def test_unemployment_from_sheet(spark, register, tmp_path):
    header = ["CODGEO", *jobs.EMPLOYED, *jobs.UNEMPLOYED]
    lines = ["Titre,,,,,,,,", "Source INSEE,,,,,,,,", ",".join(f" {h} " if i == 1 else h for i, h in enumerate(header)),
             "1001,10,10,0,0,5,5,0,0", "1001,1,1,0,0,0,0,0,0", "2A004,0,0,0,0,0,0,0,0",
             "13055,\"1 000\",s,,,10,,,", "99999,1,1,1,1,1,1,1,1"]
    path = tmp_path / "sheet.csv"
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    cells = S.read_cells(spark, str(path))
    sheet = S.promote_header(cells, "CODGEO", 20)
    out = {r["code_insee"]: r["taux_chomage"] for r in jobs.unemployment_rate(sheet, register, 2022).collect()}
    # 01001: rows 33.33 and 0.0 -> mean 16.67; 2A004 total 0 -> NULL; 13055: 10/(1000+10)
    assert out["01001"] == 16.67
    assert out["2A004"] is None
    assert out["13055"] == round(10 / 1010 * 100, 2)
    assert "99999" not in out


def test_demography_banded_median(spark, register):
    layout = jobs.age_layout()
    cols = ["DR", "CR", "STABLE"] + [c for _, m, f, _ in layout for c in (m, f)]
    young = ["10"] * 10 + ["0"] * 30     # everybody under 25
    empty = ["0"] * 40
    rows = [("1", "1", "1", *young), ("2A", "4", "1", *empty), ("13", "55", "0", *young)]
    df = spark.createDataFrame(rows, ",".join(f"`{c}` string" for c in cols))
    out = {r["code_insee"]: r for r in jobs.demography(df, register, 2022).collect()}
    assert set(out) == {"01001"}
    assert out["01001"]["pct_jeunes"] == 100.0 and out["01001"]["pct_seniors"] == 0.0
    assert out["01001"]["age_median"] == 12.5


def test_election_tie_and_accents(spark):
    reg = spark.createDataFrame([("01001", "Évian-les-Bains"), ("01002", "  ")], "code_insee string, nom_commune string")
    cands = [c for cs in jobs.CANDIDATE_BLOCS.values() for c in cs]
    cols = ["CodeInsee", "Commune", jobs.EXPRESSED, *cands]

    def row(code, **votes):
        return (code, "x", str(sum(votes.values())), *[str(votes.get(c, 0)) for c in cands])
    rows = [row("1001", **{"LE PEN.exp": 10, "MACRON.exp": 5}), row("1001", **{"MACRON.exp": 5}),
            row("1002", **{"ROUSSEL.exp": 3})]
    df = spark.createDataFrame(rows, ",".join(f"`{c}` string" for c in cols))
    out = {r["code_insee"]: r for r in jobs.election_result(df, reg, 2022).collect()}
    assert set(out) == {"01001"}  # blank name removed
    r = out["01001"]
    assert r["classe_politique"] == "extreme_droite"  # tie 10 vs 10: first bloc wins
    assert r["localisation"] == "Evian-les-Bains"
    assert r["score_extreme_droite"] == 50.0 and r["score_centre"] == 50.0


def test_bridge_and_projection(spark):
    old = spark.createDataFrame([("01001", "SAINT-ÉTIENNE", "01"), ("01002", "L'ISLE", None),
                                 ("01003", "Homonyme", "01"), ("01004", "Homonyme", "01")],
                                "COM string, NCC string, DEP string")
    new = spark.createDataFrame([("01001", "Saint Etienne", "01", None, "COM"),
                                 ("01002", "L ISLE", None, "01999", "COMD"),
                                 ("01005", "HOMONYME", "01", None, "COM")],
                                "COM string, NCC string, DEP string, COMPARENT string, TYPECOM string")
    bridge = jobs.code_bridge(old, new)
    pairs = sorted((r["Code_INSEE_2022"], r["Code_INSEE_2024"], r["Statut_2024"]) for r in bridge.collect())
    assert pairs == [("01001", "01001", "COM"), ("01002", "01999", "COMD"),
                     ("01003", "01005", "COM"), ("01004", "01005", "COM")]
    income = spark.createDataFrame([("01001", "20000"), ("01002", "30000"), ("01003", "10000"), ("01004", "12000")],
                                   "code_insee string, revenu_median string")
    unemp = spark.createDataFrame([("01001", "0"), ("01002", "25"), ("01003", "10"), ("01004", "10")],
                                  "code_insee string, taux_chomage string")
    out = {r["code_insee"]: r["revenu_estime_2024"] for r in jobs.projected_income(bridge, income, unemp).collect()}
    assert out["01001"] == 22400.0
    assert out["01999"] == 30600.0
    assert out["01005"] == round(11000 * 1.08)


def test_business_creations(spark, register):
    rows = [(0, "Créations", None, None), (1, None, None, None), (2, None, None, None), (3, None, None, None),
            (4, "1001", "x", "3"), (5, "2A004", "y", "n.d."), (6, "75056", "z", "7")]
    cells = spark.createDataFrame(rows, "row_no long, a string, b string, c string") \
        .select(F.lit("f").alias("file"), "row_no", F.array("a", "b", "c").alias("cells"))
    out = {r["code_insee"]: r["nb_creations_entreprises"]
           for r in jobs.business_creations(cells, register, 2012, 2012, 2012).collect()}
    assert out == {"01001": 3, "2A004": 0, "75056": 7}


def test_register_difference(spark):
    old = spark.createDataFrame([("1001", "A"), ("1002", "B")], "COM string, NCC string")
    new = spark.createDataFrame([("01002", "B"), ("01003", "C")], "COM string, NCC string")
    out = sorted((r["COM"], r["change"]) for r in jobs.register_difference(old, new).collect())
    assert out == [("01001", "removed"), ("01003", "added")]
