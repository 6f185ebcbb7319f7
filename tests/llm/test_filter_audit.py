"""Interaction of filters against a plain walk through every order."""

import itertools
import re
from collections import Counter

import pytest

from tabwarden.llm import filter_audit

DOCS = "doc_id bigint, text string, source string, mask int, part string, n bigint, step int, kept int"
LABELS = "doc_id bigint, quality int, toxic int, part string"
GOOD = " ".join(f"word{i}" for i in range(60))
LONG = " ".join(f"word{i % 997}" for i in range(60_000))
ROWS = [
    (1, GOOD, "a"), (2, GOOD, "a"), (2, GOOD, "a"), (3, GOOD, "b"), (4, GOOD + " #", "b"), (5, None, "a"), (6, "", None), (7, LONG, None),
    (8, "X Y Z", "b"), (None, GOOD, "a"), (None, None, "a"), (None, GOOD, "a"), (9, "same same " * 40, ""), (1, "other text", "b"), (10, "A\x0bB\x85C " * 30, "c"),
]
TOLD = [(1, 1, 0), (1, 0, 1), (2, 1, None), (4, None, 1), (None, 1, 1), (9, 0, 1), (7, 1, 0), (77, 1, 1)]


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, s, 9, "x", 1, 2, 3) for i, t, s in rows], DOCS)


def labels_of(spark, rows):
    return spark.createDataFrame([(*r, "y") for r in rows], LABELS)


def plain(rows, told):
    good, toxic = {i for i, q, _ in told if q == 1 and i is not None}, {i for i, _, t in told if t == 1 and i is not None}
    fails = []
    for i, text, source in rows:
        body = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", body)
        which = {
            "A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * len(re.findall("[A-Z]", body)) > 5 * len(body), "D": bool(re.search("[#$%&*|]", body)),
            "E": i is not None and any(j is not None and j < i and (u or "") == body for j, u, _ in rows),
        }
        fails.append((source or "", {k for k, v in which.items() if v}, i in good, i in toxic))
    out = {}
    for order in map("".join, itertools.permutations("ABCDE")):
        for part in {f[0] for f in fails}:
            left = [f for f in fails if f[0] == part]
            everyone = list(left)
            for step, x in enumerate(order, 1):
                here = [f for f in left if x in f[1]]
                left = [f for f in left if x not in f[1]]
                out[part, order, step] = [
                    len(left), len(here), sum(x in f[1] for f in everyone) - len(here), sum(f[1] == {x} for f in everyone), sum(f[2] for f in here), sum(f[3] for f in here)
                ]
    shapley = Counter()
    for (part, order, step), v in out.items():
        shapley[part, order[step - 1]] += v[1]
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


@pytest.mark.parametrize(("rows", "told"), [(ROWS, TOLD), (ROWS, []), ([], TOLD)])
def test_against_every_order(spark, rows, told):
    limit = spark.conf.get("spark.sql.cteRecursionRowLimit")
    got = filter_audit.audit(docs_of(spark, rows), labels_of(spark, told)).collect()
    assert {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in filter_audit.COUNTS) for r in got} == plain(rows, told)
    assert len(got) == 600 * len({s or "" for _, _, s in rows})
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") == limit


def test_shapley_shares_what_all_filters_remove(spark):
    got = filter_audit.audit(docs_of(spark, ROWS), labels_of(spark, TOLD)).where("filter_order = 'EDCBA'").groupBy("part").sum("removed", "shapley").collect()
    assert all(120 * r["sum(removed)"] == r["sum(shapley)"] for r in got)
