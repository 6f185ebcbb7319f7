"""Near words, forms and roots against plain comparison of all words."""

import random
import re
import zlib
from collections import Counter

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from tabwarden.llm import spelling

SCHEMA = "doc_id bigint, text string, word string, n bigint, form string, key string"


def table(spark, texts, ids=None):
    return spark.createDataFrame([(i, t, "x", 5, "y", "z") for i, t in zip(ids or range(len(texts)), texts)], SCHEMA)


def near(a, b):
    """Whether one inserted, deleted or replaced code point turns one word into the other."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    k = 0
    while k < min(len(a), len(b)) and a[k] == b[k]:
        k += 1
    return a[k + (len(a) >= len(b)) :] == b[k + (len(b) >= len(a)) :]


def plain(rows):
    count = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{low}".encode())
            if h % 31 == 0:
                low = low[: h % len(low)] + low[h % len(low) + 1 :]
            count[low] += 1
    words = {w: n for w, n in count.items() if len(w) >= 7 and n >= 2}
    around = {w: [x for x in words if near(w, x)] for w in words}
    form = {}
    for w, close in around.items():
        best = min(close, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {(w, form[w], root(w), n, len(around[w]), words.get(form[w])) for w, n in words.items()}


def rows_of(df):
    return {(r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


def mutated(pick, word):
    k = pick.randrange(len(word))
    return pick.choice([word[:k] + word[k + 1 :], word[:k] + pick.choice("abÀÿ") + word[k:], word[:k] + pick.choice("abéb") + word[k + 1 :]])


def test_against_all_pairs(spark):
    pick = random.Random(5)
    stems = ["".join(pick.choice(["ab", "ba", "aa", "éb", "b"]) for _ in range(pick.randint(4, 7))) for _ in range(60)]
    stems += [mutated(pick, w) for w in stems for _ in range(4)]
    stems += [mutated(pick, w) for w in stems]
    texts = [" ".join(pick.choice(stems).title() for _ in range(120)) for _ in range(40)]
    texts += ["Abcdefgh " * 400 + "abcdefghi " * 30 + "abcdefghij,abcdefghij. " + "xabcdefghij " * 2, None, "", "kurz", "ABCDEFGH×ÿ ABCDEFGH×ÿ", "abcdefgh"]
    ids = [None, *range(1, len(texts) - 1), 3]
    got = rows_of(spelling.variants(table(spark, texts, ids)))
    want = plain(zip(ids, texts))
    assert got == want and sum(x[4] for x in want) > 500
    assert any(w == "abcdefghij" and r == "abcdefgh" for w, f, r, *_ in got) and any(x[1] for x in want)


def test_given_documents(spark, sf):
    docs = pd.read_parquet(f"{sf}/documents.parquet")
    got = rows_of(spelling.query(spark, sf))
    runs = plain(zip(docs.doc_id, docs.text))
    assert got == runs and got


def test_very_long_and_repeated_texts(spark):
    text = " ".join(f"wörtchen{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}" for i in range(120_000))
    rows = [(1, text), (1, text), (2, "wörtchenaa" * 150_000)]
    assert rows_of(spelling.variants(table(spark, [t for _, t in rows], [i for i, _ in rows]))) == plain(rows)


def test_nothing(spark):
    assert spelling.variants(table(spark, [])).count() == 0
    assert spelling.variants(table(spark, [None, "", "once uponatime"])).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text("abà", min_size=7, max_size=12), st.integers(0, 2), st.integers(0, 12), st.sampled_from("abà"))
def test_untouched_pivot_meets_the_other_prefix(word, kind, at, letter):
    at = min(at, len(word) - 1)
    other = [word[:at] + word[at + 1 :], word[:at] + letter + word[at:], word[:at] + letter + word[at + 1 :]][kind]
    if len(other) < 7 or other == word:
        return
    grams = Counter(w[p : p + 2] for w in (word, other) for p in range(len(w) - 1))
    ranks = {g: (k, n) for k, (g, n) in enumerate(sorted(grams.items(), key=lambda x: (x[1], x[0])))}
    a, b = sorted((word, other), key=lambda w: (spelling.prefix_grams(w, ranks)[1], w))
    prefix = spelling.prefix_grams(a, ranks)[0]
    left, right = spelling.pivots(a, prefix, ranks)
    assert left + 2 <= right and {left, right} <= set(prefix)
    best = min(ranks[a[p : p + 2]][1] + ranks[a[q : q + 2]][1] for p in prefix for q in prefix if p + 2 <= q)
    assert ranks[a[left : left + 2]][1] + ranks[a[right : right + 2]][1] == best
    met = {(b[: p + 2], 0) for p in spelling.prefix_grams(b, ranks)[0]} | {(b[p:], 1) for p in spelling.prefix_grams(b, ranks)[0]}
    assert (a[: left + 2], 0) in met or (a[right:], 1) in met
