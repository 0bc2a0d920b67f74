from quarry.llm import licenses
from quarry.llm.queries import ORACLES, QUERIES
from tests.oracle_check import compare, duck


def test_query_equals_sql(spark):
    sf, name = "/root/testdata/sf0.01", "op4_tfidf_licences"
    msg, *_ = compare(spark, duck(sf), name, QUERIES[name], ORACLES[name], sf)
    assert not msg, msg


def test_paths(spark):
    junk = "Onea the of work is under version and with or. "
    files = [
        ("LICENSE", "The MIT License (MIT)\n" + junk * 3),
        ("a/x.txt", junk * 20), ("a/b/LICENSE.md", "Licensed under the Apache License, Version 2.0."),
        ("a/b/c/d/deep.txt", junk), ("a/b/own.txt", junk + "\nReleased under the ISC License.\nLicensed under CC BY-NC 4.0.\n" + junk * 50),
        ("a/bc/other.txt", junk), ("z/empty.txt", ""), ("z/null.txt", None), (None, "x"), ("top.txt", "MIT"),
        ("q/only", "This work is licensed under the GNU General Public License, version 3."), ("q/r/y", junk),
        ("a/x.txt", junk * 20), ("long.txt", "word " * 200_000)]
    df = spark.createDataFrame([(p, t, 1.0) for p, t in files], "path string, text string, score double")
    got = licenses.scan_licences(df).collect()
    assert len(got) == len(files)
    of = {r.path: (r.licence, r.origin, r.licence_dir) for r in got}
    assert of == {
        "LICENSE": ("MIT", "own", None), "a/x.txt": ("MIT", "inherited", ""), "a/b/LICENSE.md": ("Apache-2.0", "own", None),
        "a/b/c/d/deep.txt": ("Apache-2.0", "inherited", "a/b"), "a/b/own.txt": of["a/b/own.txt"],
        "a/bc/other.txt": ("MIT", "inherited", ""), "z/empty.txt": ("MIT", "inherited", ""),
        "z/null.txt": ("MIT", "inherited", ""), None: ("MIT", "inherited", ""), "top.txt": ("MIT", "inherited", ""),
        "q/only": ("GPL-3.0", "own", None), "q/r/y": ("GPL-3.0", "inherited", "q"), "long.txt": ("MIT", "inherited", "")}
    assert next(r.licences for r in got if r.path == "a/b/own.txt") == ["CC-BY-NC-4.0", "ISC"]
    assert licenses.scan_licences(df.limit(0)).count() == 0


def test_anchors_lose_nothing():
    _, _, rows = licenses._weights(1000, {"the": 900, "is": 800, "of": 700, "under": 500}, licenses.PHRASES)
    anchors = licenses._anchors(rows, 0.75)
    for number in {r[1] for r in rows}:
        assert sum(r[3] ** 2 for r in rows if r[1] == number and r[2] not in anchors) < 0.75 ** 2
