import hashlib
import os
import re

import duckdb
import pytest
from helpers_llm import MEDIUM, make, table  # noqa: F401
from ohlcflow.llm import licenses
from ohlcflow.llm.license_texts import LICENCES, NOTICES
from ohlcflow.llm.oracle import oracle_sql
from ohlcflow.llm.queries import op1_license_scan


def scan(df):
    return {r["doc_id"]: (r["license"], r["notices"]) for r in licenses.scan_licences(df).collect()}


def test_every_known_text_is_found(spark, make):
    rows = [(i, text) for i, (_, _, text) in enumerate(LICENCES)]
    got = scan(make(rows))
    assert [got[i][0] for i in range(len(rows))] == [name for name, _, _ in LICENCES]


def test_whole_texts_are_found(spark, make):
    folder = "/usr/share/common-licenses"
    if not os.path.isdir(folder):
        pytest.skip("no licence texts here")
    names = {"Apache-2.0": "Apache-2.0", "GPL-2": "GPL-2.0-only", "GPL-3": "GPL-3.0-only", "LGPL-3": "LGPL-3.0-only",
             "LGPL-2.1": "LGPL-2.1-only", "MPL-2.0": "MPL-2.0", "MPL-1.1": "MPL-1.1", "CC0-1.0": "CC0-1.0"}
    files = sorted(f for f in names if os.path.exists(f"{folder}/{f}"))
    texts = [open(f"{folder}/{f}", encoding="utf-8").read() for f in files]
    end = "END OF TERMS AND CONDITIONS"
    rows = [(k, " ".join(t.upper().split(" "))) for k, t in enumerate(texts) if "copyright" in t.lower()]
    rows += [(100 + k, t[: t.find(end) + len(end)]) for k, t in enumerate(texts) if end in t]
    got = scan(make(rows))
    assert [got[d][0] for d, _ in rows] == [names[files[d % 100]] for d, _ in rows]


def test_digests_of_the_caller(spark, make):
    rows = [(1, "My own Licence.\nCopyright (c) 2020 Me\nDo as you like."), (2, "Do as you like.")]
    own = licenses.scan_licences(make(rows)).where("doc_id = 1").first()["canonical_digest"]
    got = {r["doc_id"]: r["license"] for r in licenses.scan_licences(make(rows), digests={own: "Mine"}).collect()}
    assert got == {1: "Mine", 2: None}


def test_disguises_do_not_matter(spark, make):
    name, title, text = LICENCES[0]
    wrapped = "\n".join(re.findall(r"(?:\S+\s*){1,9}", text))
    british = text.replace("sublicense", "sub-license")
    rows = [
        (1, f"{title}\n\nCopyright (c) 2021 Some Body\n\n{text}"),
        (2, f"/* {title.upper()}\n * Copyright © 1999-2003, Somebody else.\n * All rights reserved.\n"
            + "\n".join(" * " + x for x in wrapped.split("\n")) + " */"),
        (3, british.upper().replace(" ", "  ")),
        (4, text + " and more"),
        (5, text.replace("free of charge", "for a charge")),
    ]
    got = scan(make(rows))
    assert [got[i][0] for i in range(1, 6)] == [name, name, name, None, None]


def test_notices(spark, make):
    rows = [
        (1, "Some prose.\nReleased under the MIT License."),
        (2, "# released under the mit licence\nmore\nLicensed under CC BY-NC 4.0."),
        (3, "It was released under the MIT License. Or so they say."),
        (4, "Released under the MIT License.\nLicensed under the MIT License."),
        (5, "Released under the MIT License."),
    ]
    got = scan(make(rows))
    assert [got[i][1] for i in range(1, 6)] == [["MIT"], ["CC-BY-NC-4.0", "MIT"], [], ["MIT"], ["MIT"]]
    assert got[5][0] == "MIT" and got[1][0] is None


def test_edge_cases(spark, make):
    rows = [(1, None), (2, ""), (3, "?! --"), (4, "© 2020"), (5, "word " * 40_000), (6, "dup"), (6, "dup"), (None, "x")]
    df = make(rows)  # has columns named like the result's: those of the result stay
    out = licenses.scan_licences(df).collect()
    assert len(out) == len(rows) and all(r["license"] is None and r["notices"] == [] for r in out)
    empty = hashlib.sha256(b"").hexdigest()
    assert {r["canonical_digest"] for r in out if r["doc_id"] in (1, 2, 3, 4)} == {empty}
    assert licenses.scan_licences(make([])).collect() == []


@pytest.mark.parametrize("sf", [MEDIUM])
def test_query_matches_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    rel = con.execute(oracle_sql()["op1_license_scan"])
    names = [c[0] for c in rel.description]
    want = sorted((tuple(dict(zip(names, r))[c] for c in sorted(names)) for r in rel.fetchall()), key=str)
    got = sorted((tuple(r[c] for c in sorted(names)) for r in op1_license_scan(spark, sf).collect()), key=str)
    assert got == want


def test_main_path_is_native(spark, make):
    plan = licenses.scan_licences(make([(1, "x")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
    assert len(NOTICES) < 200  # the broadcast side is this fixed list
