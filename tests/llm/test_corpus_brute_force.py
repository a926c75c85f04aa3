"""Brute-force versions of the operators that SQL can't express, over the smallest tables and odd frames."""

import bisect
import math
import os
import sys
from collections import defaultdict

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from conftest import DATA
from test_corpus_ops import similar_groups

import corpus_pipeline
from tarnflow.llm import exact_dedup, packing, quality_gam, queries, secret_scan, simhash, substring_dedup
from tarnflow.session import read_table

RUN = substring_dedup.RUN


def words_of(text):
    return [w for line in (text or "").lower().encode().split(b"\n") for w in line.split()]


def lines_of(text):
    at, out = 0, []
    for line in (text or "").lower().encode().split(b"\n"):
        words = line.split()
        if len(words) >= substring_dedup.MIN_WORDS:
            out.append((at, at + len(words), tuple(words)))
        at += len(words)
    return out


def test_repeats_by_brute_force(spark):
    docs = {r.doc_id: r.text for r in read_table(spark, DATA, "documents").collect()}
    found = defaultdict(list)
    for r in queries.op2_substring_dedup(spark, DATA).collect():
        found[r.doc_id].append(r)
    # Lines: components of all pairs of distinct lines of 0.8 or more.
    lines = sorted({w for t in docs.values() for _, _, w in lines_of(t)})
    groups, _ = similar_groups([" ".join(x.hex() for x in w) for w in lines])
    owners = defaultdict(set)
    for i, t in docs.items():
        for _, _, w in lines_of(t):
            owners[groups[lines.index(w)]].add(i)
    for i, t in docs.items():
        want = {(a, b) for a, b, w in lines_of(t) if len(owners[groups[lines.index(w)]]) > 1}
        assert {(r.from_word, r.to_word) for r in found[i] if r.kind == "paragraph"} == want
    for root, ids in owners.items():  # one keeper a class, the least document
        if len(ids) > 1:
            rows = [r for i in ids for r in found[i] if r.kind == "paragraph" and any((a, b) == (r.from_word, r.to_word) and groups[lines.index(w)] == root for a, b, w in lines_of(docs[i]))]
            assert len({r.class_id for r in rows}) == 1 and {r.doc_id for r in rows if r.kept} == {min(ids)}
    # Runs of 51 words that several documents have.
    runs = defaultdict(set)
    for i, t in docs.items():
        words = words_of(t)
        for k in range(len(words) - RUN + 1):
            runs[tuple(words[k : k + RUN])].add(i)
    shared = {i: [k for k in range(len(words_of(t)) - RUN + 1) if len(runs[tuple(words_of(t)[k : k + RUN])]) > 1] for i, t in docs.items()}
    assert sum(map(bool, shared.values())) > 10
    for i, starts in shared.items():
        rows = [r for r in found[i] if r.kind == "window"]
        for k in starts:
            assert max((min(k + RUN, r.to_word) - max(k, r.from_word) for r in rows), default=0) >= substring_dedup.WINDOW
        for r in rows:  # nothing short is reported without such a run
            assert r.to_word - r.from_word >= RUN + substring_dedup.WINNOW - 1 or any(r.from_word <= k and k + RUN <= r.to_word for k in starts)


def plain_features(text):
    """The sixteen features, letter by letter."""
    if not text:
        return [0.0] * 16
    words, lines = text.split(), [x for x in text.split(b"\n") if x]
    n, size = max(1, len(words)), len(text)
    among = lambda chars: sum(c in chars.encode() for c in text) / size
    longest = 0
    for w in words:
        longest = max(longest, len(w))
    return [
        math.log(1 + size), math.log(1 + len(words)), sum(c not in b" \t\n\r\x0b\x0c" for c in text) / n, len(words) / max(1, len(lines)),
        sum(65 <= c <= 90 for c in text) / size, sum(48 <= c <= 57 for c in text) / size, among(" \t\n\r\x0b\x0c"), sum(c > 127 for c in text) / size,
        among(",;:'\"-()!"), among("#$%&*+/<=>@[\\]^_`{|}~"), sum(w[-1:] in [bytes([c]) for c in b"#$%&*+/<=>@[\\]^_`{|}~!"] for w in words) / n,
        len(set(words)) / n, sum(a == b for a, b in zip(words, words[1:], strict=False)) / n, len(set(lines)) / max(1, len(lines)),
        (text.count(b".") + text.count(b"?")) / n, math.log(1 + longest),
    ]


ODD = [None, "", " ", "\n\n", "x", "A.B? c", "ü" * 40, "a" * 5000, "w " * 30_000, "same same same", "1 2\n1 2\n", "#! $$$ ~~~", "é\x00\x1c b"]


def test_scores_by_brute_force(spark):
    docs, labels = read_table(spark, DATA, "documents"), read_table(spark, DATA, "labels")
    model = quality_gam.train(docs, labels)
    rows = [(r.doc_id, r.text, "x", 1) for r in docs.collect()]
    rows += [(10**9 + i, t, "x", 1) for i, t in enumerate(ODD)] + [(None, "no id", "x", 1), (rows[0][0], rows[0][1], "y", 2)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, score string, predicted int")
    got = quality_gam.score(frame, model, ["doc_id"]).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    for i, text, *_ in rows:
        x = plain_features((text or "").encode())
        total = model.base
        for value, edges, table in zip(x, model.edges, model.tables, strict=True):
            total += table[bisect.bisect_right(list(edges), value)]
        for a, b, first, second, grid in model.pairs:
            total += grid[bisect.bisect_right(list(first), x[a])][bisect.bisect_right(list(second), x[b])]
        assert by_id[i].score == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-9), text
        assert by_id[i].predicted == (by_id[i].score >= 0.3)
    kept = quality_gam.accepted(frame, model)
    assert kept.columns == frame.columns
    assert sorted((r.doc_id or 0, r.score) for r in kept.collect()) == sorted((i or 0, s) for i, t, s, _ in rows if by_id[i].predicted)
    twice = quality_gam.train(docs.unionByName(docs), labels.unionByName(labels))
    assert np.allclose([t.sum() for t in twice.tables], [t.sum() for t in model.tables])


CLASHING = "doc_id long, text string, score string, predicted int, id long, key string, kept string, spans string, component long, r long, n long, row string, n_chars int"


def test_stages_on_odd_documents(spark):
    """Nulls, empty and long texts, repeated rows and columns with the operators' own names go through every stage."""
    good = [r.text for r in read_table(spark, DATA, "documents").limit(40).collect()]
    texts = [*good, *good[:5], *ODD, good[6].upper(), good[7] + " end", "token=abcdefgh1 " + good[8]]
    rows = [(i if i != 3 else None, t, "s", 1, i, "k", "y", "sp", 1, 2, 3, "w", 7) for i, t in enumerate(texts)] + [(5, texts[5], "s", 1, 5, "k", "y", "sp", 1, 2, 3, "w", 7)]
    docs = spark.createDataFrame(rows, CLASHING).repartition(3)
    kept = corpus_pipeline.STAGES[0][1](spark, docs, DATA)
    model = quality_gam.train(docs, read_table(spark, DATA, "labels"))
    scores = [r.predicted for r in quality_gam.score(docs, model, ["doc_id"]).collect()]
    assert kept.columns == docs.columns and kept.count() == sum(scores)
    exact = corpus_pipeline.STAGES[1][1](spark, docs, DATA)
    lower = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    assert exact.columns == docs.columns and exact.count() == len({lower(t) for t in texts})
    near = corpus_pipeline.STAGES[2][1](spark, exact, DATA)
    left = [r.text for r in exact.collect()]
    roots, _ = similar_groups(left)
    empty = len([t for t in left if not (t or "").split()])
    assert near.columns == docs.columns and near.count() == len(set(roots)) - max(0, len({roots[i] for i, t in enumerate(left) if not (t or "").split()}) - 1)
    assert empty >= 1
    clean = corpus_pipeline.STAGES[3][1](spark, near, DATA)
    assert clean.columns == docs.columns and secret_scan.scan(clean, ["doc_id"]).where("n_assign > 0").count() == 0
    packed = corpus_pipeline.STAGES[4][1](spark, clean, DATA)
    assert packed.where("piece = 0").count() == clean.count()


def test_stages_on_an_empty_table(spark):
    empty = spark.createDataFrame([], CLASHING)
    for name, apply in corpus_pipeline.STAGES:
        out = apply(spark, empty, DATA)
        assert out.count() == 0 and (name == "packing" or out.columns == empty.columns)


def test_passages_are_cut_from_odd_rows(spark):
    shared = " ".join(f"word{i}" for i in range(60))
    rows = [(1, shared, 1, "c"), (2, f"one two\n{shared}\nlast", 2, "c"), (2, f"one two\n{shared}\nlast", 2, "c"), (3, None, 3, "c"), (None, shared, 4, "c"), (4, "", 5, "c")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, id long, cuts string")
    passages = substring_dedup.repeats(frame)
    out = sorted((r.id, r.text, r.cuts) for r in substring_dedup.without_repeats(frame, passages).collect())
    assert out == [(1, shared, "c"), (2, "one two\nlast", "c"), (2, "one two\nlast", "c"), (3, None, "c"), (4, shared, "c"), (5, "", "c")]
    assert substring_dedup.without_repeats(frame.limit(0), passages).count() == 0
    assert {packing.CAPACITY, exact_dedup.SUPPORT, simhash.DISTANCE} == {4096, 1 / 4096, 2}
