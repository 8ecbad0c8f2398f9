"""Collocations against all counts at once."""

import random
import re
from collections import Counter

import duckdb
import pytest

from recordtide.llm import collocations as C
from tests.llm.conftest import ODD_ROWS, prose


def brute(rows, limit=C.LIMIT, least=C.LEAST):
    counts, total = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, 5):
                counts.setdefault(lang, Counter()).update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        rest = []
        for p, a in found.items():
            around = [q for q in found if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if any(100 * found[q] >= 80 * a for q in around):
                continue
            score, _, l, r = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            rest.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(rest)[:limit], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, total[lang], -score))
    return sorted(out)


def got(frame):
    return sorted(tuple(r[c] for c in "lang rank phrase a l r n score".split()) for r in frame.collect())


def corpus(seed, n, words):
    """Texts with fixed phrases of several lengths among random words."""
    choose = random.Random(seed)
    fixed = [[choose.choice(words) for _ in range(choose.choice([2, 3, 4, 5]))] for _ in range(12)]
    rows = []
    for _ in range(n):
        text = []
        while len(text) < 60:
            text += choose.choice(fixed) if choose.random() < 0.4 else [choose.choice(words)]
            if choose.random() < 0.1:
                text[-1] += choose.choice([".", ",", ";", "\n", "!"])
        rows.append((choose.choice(["x", "x", "y", None]), " ".join(text)))
    return rows


@pytest.mark.parametrize("limit", [3, 25, C.LIMIT])
def test_against_all_counts(spark, limit):
    """Small limits end the search early; the list is the same."""
    rows = corpus(1, 220, "ab cd Ef gh ij kl mn".split())
    frame = spark.createDataFrame([(k, lang, text) for k, (lang, text) in enumerate(rows)], "doc_id long, lang string, text string").repartition(5)
    assert got(C.collocations(frame, limit)) == brute(rows, limit)


def test_ties_at_the_end(spark):
    """Many phrases of one score: the end of the list is settled by count and phrase."""
    rows = [("x", f"{a}1 {a}2") for a in "zyxwvutsrq" for _ in range(30 + (a == "q"))]
    frame = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "doc_id long, lang string, text string")
    assert got(C.collocations(frame, 4)) == brute(rows, 4)
    assert [r[2] for r in got(C.collocations(frame, 4))] == ["q1 q2", "r1 r2", "s1 s2", "t1 t2"]


def test_blocks_do_not_matter(spark, monkeypatch):
    """Texts of many languages in blocks of any size give the same words and the same places."""
    rows = corpus(2, 150, "ab cd ef gh ij".split()) + [(f"l{k}", "ab cd. ef") for k in range(300)]
    parts = spark.createDataFrame([(lang or "und", text) for lang, text in rows], "lang string, text string").toArrow().to_batches(max_chunksize=40)

    def counts():
        total = Counter()
        blocks = (part.select(["lang", "words", "counts"]) for part in C._encode(iter(parts)))
        for part in C._count_words(blocks):
            for lang, phrase, _, n in zip(*(c.to_pylist() for c in part.columns)):
                total[lang, phrase] += n
        return total

    whole = counts()
    assert sum(whole.values()) == sum(r[-2] for r in {r[0]: r for r in brute(rows, least=1)}.values())
    monkeypatch.setattr(C, "SPLIT", 300)
    monkeypatch.setattr(C, "BLOCK", 100)
    monkeypatch.setattr(C, "KNOWN", 3)
    assert counts() == whole


def test_odd_rows(spark, odd):
    schema = "doc_id long, text string, lang string, score string, phrase string, size string, n string, floor string"
    rows = [(a, b, ["en", None, "", "und"][k % 4], *"abcde") for k, (a, b) in enumerate(ODD_ROWS)] + [(20, prose(9, 20_000), "en", *"abcde")]
    frame = spark.createDataFrame(rows, schema).repartition(3)
    assert got(C.collocations(frame)) == brute([(r[2], r[1]) for r in rows])
    assert C.collocations(frame.filter("1 = 0")).count() == 0
    assert C.collocations(frame.filter("text is null or text = ''")).count() == 0


def test_words_with_strange_characters(spark):
    text = "Été\x00a \x1c' ÀB \"q\\ %_ " * 40
    frame = spark.createDataFrame([(1, text, "x"), (2, text.replace(" ", "\t"), "x")], "doc_id long, text string, lang string")
    assert got(C.collocations(frame)) == brute([("x", text), ("x", text.replace(" ", "\t"))])


def test_sql_on_the_fixture(spark):
    rows = corpus(3, 200, "ab cd Ef gh ij kl mn".split())
    frame = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "doc_id long, lang string, text string")
    duck = duckdb.connect()
    duck.register("documents", frame.toArrow())
    columns = [c[0] for c in duck.execute(C.SQL).description]
    found = [dict(zip(columns, row)) for row in duck.fetchall()]
    assert sorted(tuple(r[c] for c in "lang rank phrase a l r n score".split()) for r in found) == brute(rows)


def test_blocks_are_written_with_zstd(spark, monkeypatch):
    codecs, cut = [], C.cut_lineage
    monkeypatch.setattr(C, "cut_lineage", lambda df, codec="snappy": codecs.append((df.columns, codec)) or cut(df, codec))
    frame = spark.createDataFrame([("en", "one two three. " * 40)], "lang string, text string")
    assert got(C.collocations(frame))
    assert [codec for columns, codec in codecs if "ids" in columns] == ["zstd", "zstd"]
