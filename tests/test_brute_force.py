"""Sequential or all-pairs versions of the operators whose queries have no SQL, over the smallest tables."""

import math
import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from conftest import DATA
from oracle import connection

from tarnflow.operators import error_model as E, letters as L, pairs as Q, similarity as Y
from tarnflow.plans import registry
from tarnflow.plans.derived import READS, sql
from tarnflow.schema import COMPLEMENT


@pytest.fixture(scope="module")
def con():
    return connection(DATA)


@pytest.fixture(scope="module")
def unique(con):
    rows = con.execute(f"select project, md5(upper(seq)), upper(seq), count(*) from {sql(READS)} group by project, upper(seq)").fetchall()
    out = defaultdict(dict)
    for project, i, seq, size in rows:
        out[project][i] = (seq, size)
    return out


def edits(con, seqs, identity):
    """Edits of all pairs with at least the identity, by comparing all of them."""
    con.execute("create or replace temp table s(id varchar, seq varchar)")
    con.executemany("insert into s values (?, ?)", [[i, s] for i, s in seqs.items()])
    rows = con.execute(f"""
        select a.id, b.id, levenshtein(a.seq, b.seq) from s a, s b where a.id <> b.id
        and abs(length(a.seq) - length(b.seq)) <= floor(greatest(length(a.seq), length(b.seq)) * (1 - {identity}) + 1e-9)
        and levenshtein(a.seq, b.seq) <= floor(greatest(length(a.seq), length(b.seq)) * (1 - {identity}) + 1e-9)""").fetchall()
    return {(u, v): e for u, v, e in rows}


def greedy(sizes, near):
    """Most abundant first: each sequence joins the nearest earlier centroid, the more abundant of equals, or becomes one."""
    order, centroid = sorted(sizes, key=lambda i: (-sizes[i], i)), {}
    rank = {i: k for k, i in enumerate(order)}
    for i in order:
        options = [(near[i, c], rank[c], c) for c in order[: rank[i]] if centroid[c] == c and (i, c) in near]
        centroid[i] = min(options)[2] if options else i
    return centroid


def test_otus(spark, con, unique):
    got = defaultdict(dict)
    for r in registry.queries()["otu_cluster97"](spark, DATA).collect():
        got[r.project][r.id] = r.centroid
    for project, seqs in unique.items():
        assert got[project] == greedy({i: n for i, (_, n) in seqs.items()}, edits(con, {i: s for i, (s, _) in seqs.items()}, 0.97))


def test_unoise(spark, con, unique):
    got = defaultdict(dict)
    for r in registry.queries()["unoise"](spark, DATA).collect():
        got[r.project][r.id] = r.size
    for project, seqs in unique.items():
        kept = {i: x for i, x in seqs.items() if x[1] >= 2}
        sizes = defaultdict(int)
        for i, c in greedy({i: n for i, (_, n) in kept.items()}, edits(con, {i: s for i, (s, _) in kept.items()}, 0.99)).items():
            sizes[c] += kept[i][1]
        near = {(u, v): e for (u, v), e in edits(con, {i: kept[i][0] for i in sizes}, 0.9).items() if sizes[u] / sizes[v] <= 2.0 ** -(2 * e + 1)}
        total = defaultdict(int)
        for i, c in greedy(dict(sizes), near).items():
            total[c] += sizes[i]
        assert got[project] == total


def test_error_model(spark, unique):
    """The partition by plain loops: one new centre a centre and round."""
    got = defaultdict(dict)
    for r in registry.queries()["error_model"](spark, DATA).collect():
        got[r.project][r.id] = r.reads
    lanes = defaultdict(dict)
    for project, seqs in unique.items():
        for i, (s, n) in seqs.items():
            if n >= 2:
                lanes[project, len(s)][i] = (s, n)
    centres = {lane: [min(x, key=lambda i, x=x: (-x[i][1], i))] for lane, x in lanes.items()}
    rates = np.array([1 - 3 * E.START if k % 5 == 0 else E.START for k in range(16)])
    code = {c: k for k, c in enumerate("ACGT")}
    held = {}

    def subs(a, b):
        if (a, b) not in held:
            counts = np.zeros(16)
            for x, y in zip(a, b, strict=True):
                if x in code and y in code:
                    counts[4 * code[x] + code[y]] += 1
            held[a, b] = counts
        return held[a, b]

    def chance(a, b):
        total = 0.0
        for n, r in zip(subs(a, b).tolist(), rates.tolist(), strict=True):
            total += n * math.log(r)
        return total

    while True:
        best, sums = {}, np.zeros(16)
        for lane, x in lanes.items():
            for i, (s, n) in x.items():
                best[lane, i] = min((c != i, -chance(x[c][0], s), c) for c in centres[lane])[2]
                sums += subs(x[best[lane, i]][0], s) * n
        table = sums.reshape(4, 4) + np.eye(4) * 100 + 0.1
        rates = (table / table.sum(axis=1, keepdims=True)).ravel()
        new = []
        for lane, x in lanes.items():
            for c in centres[lane]:
                own = [i for i in x if best[lane, i] == c]
                reads = sum(x[i][1] for i in own)
                tested = []
                for i in own:
                    if i != c:
                        p = float(E.abundance_p(np.array([x[i][1]]), np.array([reads * math.exp(chance(x[c][0], x[i][0]))]))[0])
                        if p * len(x) < E.OMEGA:
                            tested.append((p, -x[i][1], i))
                if tested:
                    new.append((lane, min(tested)[2]))
        if not new:
            break
        for lane, i in new:
            centres[lane].append(i)
    want = defaultdict(lambda: defaultdict(int))
    for (lane, i), c in best.items():
        want[lane[0]][c] += lanes[lane][i][1]
    assert {p: dict(v) for p, v in want.items()} == dict(got)


def test_abundance_p_by_summing():
    for size, expected in ((1, 0.5), (2, 0.01), (5, 3.0), (40, 12.0), (3, 400.0), (1000, 900.0), (7, 0.0)):
        got = float(E.abundance_p(np.array([size]), np.array([expected]))[0])
        if expected == 0:
            assert got == (1.0 if size <= 1 else 0.0)
            continue
        terms = [k * math.log(expected) - expected - math.lgamma(k + 1) for k in range(size, size + 3000)]
        want = min(1.0, math.fsum(math.exp(t) for t in terms) / -math.expm1(-expected)) if size > 1 else 1.0
        assert got == pytest.approx(want, rel=1e-9)


def flipped(seq):
    return seq.translate(str.maketrans(*COMPLEMENT))[::-1]


def plain_insert(a, b):
    """The best overlap by trying every size."""
    back, best = flipped(b), None
    for size in range(Q.LEAST_OVERLAP, len(a) + len(back) - Q.LEAST_OVERLAP + 1):
        start = size - len(back)
        spots = [i for i in range(size) if i < len(a) and 0 <= i - start < len(back)]
        if len(spots) >= Q.LEAST_OVERLAP:
            rate = sum(a[i] != back[i - start] for i in spots) / len(spots)
            if rate < Q.MOST_SHARE + 1e-9 and (best is None or (rate, -len(spots)) < best[0]):
                best = ((rate, -len(spots)), size)
    return best[1] if best else -1


def test_mates_by_every_size():
    draw = random.Random(12)
    dna = lambda n: "".join(draw.choice("ACGT") for _ in range(n))
    rows = []
    for _ in range(200):
        whole = dna(draw.randint(12, 90))
        first, second = (whole + dna(40))[:50], (flipped(whole) + dna(40))[: draw.choice((30, 50))]
        for _ in range(draw.randint(0, 3)):
            at = draw.randrange(len(first))
            first = first[:at] + draw.choice("ACGTN") + first[at + 1 :]
        rows.append((first, second, "".join(draw.choice("#5I") for _ in first), "".join(draw.choice("#5I") for _ in second)))
    rows += [("", "ACGT", "", "IIII"), ("ACG", "CGT", "III", "III")]
    a, b, qa, qb = (pa.array(x) for x in zip(*rows, strict=True))
    sizes = Q._insert_lengths(a, b).to_pylist()
    assert sizes == [plain_insert(x, y) if x and y else -1 for x, y, *_ in rows]
    good = [i for i, n in enumerate(sizes) if n > 0]
    assert len(good) > 100
    made = Q._merge(*(x.take(pa.array(good)) for x in (a, b, qa, qb)), pa.array([sizes[i] for i in good])).to_pylist()
    for i, m in zip(good, made, strict=True):
        first, second, q1, q2 = rows[i]
        back, back_q, start = flipped(second), q2[::-1], sizes[i] - len(second)
        seq = ""
        for k in range(sizes[i]):
            one, two = k < len(first), 0 <= k - start < len(back)
            seq += first[k] if one and (not two or q1[k] >= back_q[k - start]) else back[k - start]
        assert m["seq"] == seq


def test_read_scores_by_letters():
    reads = ["", "A", "acgtN", "ACGT" * 20, "RYAC", "é", "N" * 60, "aAaA", None]
    quals = ["", "!", "IIIII", "5" * 80, "####", "I", "I" * 60, "!!!!", None]
    got = L.gate_scores(pa.array(reads), pa.array(quals))
    for i, (s, q) in enumerate(zip(reads, quals, strict=True)):
        s, q = (s or "").upper(), q or ""
        counts = [s.count(x) for x in "ACGT" if x in s]
        assert got["length"][i] == len(s)
        assert got["complexity"][i] == len({s[k : k + 2] for k in range(len(s) - 1)}) / 16
        assert got["entropy"][i] == pytest.approx(-sum(n / sum(counts) * math.log2(n / sum(counts)) for n in counts))
        assert got["quality"][i] == pytest.approx(sum(map(ord, q)) / len(q) - 33 if q else 0)


def test_pairs_at_any_identity(spark, con):
    """No similar pair is missed, however many edits the identity allows for short sequences."""
    draw = random.Random(3)
    seqs = {}
    for g in range(12):
        base = "".join(draw.choice("ACGT") for _ in range(draw.choice((12, 40, 100))))
        for k in range(6):
            s = list(base)
            for at in draw.sample(range(len(s)), min(len(s) // 10, k)):
                s[at] = draw.choice("ACGT")
            seqs[f"{g}-{k}"] = "".join(s)
    frame = spark.createDataFrame(list(seqs.items()), "id string, seq string")
    got = {(r.q, r.t): r.edits for r in Y.similar_pairs(frame, frame, [], 0.9, same=True).collect()}
    assert got == edits(con, seqs, 0.9) and len(got) > 100
