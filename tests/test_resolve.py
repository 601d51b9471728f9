from pyspark.sql import functions as F

from urbanlens import config as C
from urbanlens.operators import resolve as E


def _resolve(spark, names, overrides=()):
    reg = spark.createDataFrame([("ST_001", "KING", "YU"), ("ST_002", "ST GEORGE", "BD"),
                                 ("ST_003", "KINGSWAY", "BD"), ("ST_004", "UNION", "YU")],
                                "station_key string, canonical_station_name string, line_code string")
    lookup = reg.select(F.col("canonical_station_name").alias("core_name"), "station_key", "line_code")
    n = spark.createDataFrame(names, "raw_station_name string, primary_line string")
    o = spark.createDataFrame(list(overrides), "raw_station_name string, station_key string, line_code string") \
        if overrides else None
    return {r.raw_station_name: (r.station_key, r.line_code, r.rule)
            for r in E.resolve_names(n, lookup, reg, o).collect()}


def test_rule_cascade(spark):
    got = _resolve(spark, [
        ("KING STATION", "YU"), ("KING STN", "YU"), ("ST GEORGE YARD", "BD"), ("UNION YU", "YU"),
        ("KING TO UNION", "YU"), ("UNION AND KING", "YU"), ("NEAR KINGSWAY LOOP", "BD"),
        ("APPROACHING ST GEORGE", "BD"), ("NOWHERE", "YU/BD"), ("SOMEWHERE", "SHEP"),
        ("KING STATION (TOWARDS UNION", "YU"),
    ], overrides=[("KING STN", "ST_004", "YU")])
    assert got["KING STN"] == ("ST_004", "YU", 1)                    # override beats normalisation
    assert got["KING STATION"] == ("ST_001", "YU", 2)
    assert got["ST GEORGE YARD"] == ("ST_002", "BD", 2)               # facility suffix
    assert got["UNION YU"] == ("ST_004", "YU", 2)                     # line suffix
    assert got["KING STATION (TOWARDS UNION"] == ("ST_001", "YU", 2)  # cut at first listed marker
    assert got["KING TO UNION"] == ("ST_001", "YU", 3)
    assert got["UNION AND KING"] == ("ST_004", "YU", 4)
    assert got["NEAR KINGSWAY LOOP"] == ("ST_003", "BD", 5)           # longest contained (KINGSWAY > KING)
    assert got["APPROACHING ST GEORGE"][0] == "ST_002"
    assert got["NOWHERE"] == ("ST_000", "YU", 8)                      # mixed YU/BD -> YU
    assert got["SOMEWHERE"] == ("ST_000", "SHP", 8)


def test_suffix_lists_have_no_nested_entries():
    # strip_suffix relies on: no entry of a list ends with another entry
    for lst in (C.STATION_SUFFIXES, C.FACILITY_SUFFIXES, C.LINE_SUFFIXES):
        for a in lst:
            for b in lst:
                assert a == b or not a.endswith(b)


def test_code_classification(spark):
    codes = spark.createDataFrame([(c,) for c in ("MUSC", "PUWEA", "EUATC", "Diversion", "PTW", "ZZ", "MU",
                                                  "TUDDX", "PRXQ", "X")], "delay_code string")
    sfx = spark.createDataFrame([("SC", "Speed Control"), ("D", "Door"), ("DD", "Door Delay")],
                                "suffix string, description string")
    got = {r.delay_code: (r.delay_description, r.delay_category) for r in E.classify_codes(codes, sfx).collect()}
    assert got["MUSC"] == ("Speed Control", "Mechanical")
    assert got["PUWEA"][1] == "Weather"
    assert got["EUATC"][1] == "Signal"
    assert got["Diversion"] == ("Diversion", "Operations")
    assert got["PTW"][1] == "Weather"
    assert got["ZZ"] == ("ZZ", "General")
    assert got["MU"] == ("Mechanical - General", "Mechanical")
    assert got["TUDDX"] == ("Door Delay", "Operations")                # longest suffix prefix
    assert got["PRXQ"] == ("SRT Passenger - Code XQ", "Passenger")
    assert got["X"] == ("X", "General")


def test_neighbourhood(spark):
    df = spark.createDataFrame([(["E-Charging", " Annex "],), (["E-Charging", "West"],), ([],), (["Watefront"],)],
                               "groups array<string>")
    assert [r[0] for r in df.select(E.neighbourhood("groups")).collect()] == ["Annex", "West", "Downtown", "Waterfront"]


def test_equally_long_names_take_registry_order(spark):
    names = spark.createDataFrame([("DELAY BLOOR ANNEX",)], "name string")
    lookup = spark.createDataFrame([("BLOOR", "ST_002", "YU", 0), ("ANNEX", "ST_001", "BD", 1)],
                                   "core_name string, station_key string, line_code string, ordinal int")
    from urbanlens.operators import resolve as R

    assert [r.station_key for r in R._longest_contained(names, lookup, 5).collect()] == ["ST_002"]


def test_every_prefix_has_a_label(spark):
    from urbanlens import config as C
    from urbanlens.operators import resolve as R

    assert set(C.PREFIX_LABEL) == set(C.PREFIX_CATEGORY)
    codes = spark.createDataFrame([(p + s,) for p in C.PREFIX_LABEL for s in ("", "XQ")], "delay_code string")
    none = spark.createDataFrame([], "suffix string, description string")
    got = {r.delay_code: r.delay_description for r in R.classify_codes(codes, none).collect()}
    assert got["NT"] == "Streetcar General - General" and got["SFXQ"] == "Fleet Security - Code XQ"
    assert got["MTXQ"] == "Streetcar Mechanical - Code XQ" and all(" - " in d for d in got.values())
