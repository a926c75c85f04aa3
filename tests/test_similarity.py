"""Similarity operators against brute force."""

import random

from pyspark.sql import functions as F

from tarnflow.operators import error_model as E, pairs as Q, similarity as Y, taxonomy as N
from tarnflow.session import stage

RANDOM = random.Random(5)


def dna(n):
    return "".join(RANDOM.choice("ACGT") for _ in range(n))


def mutated(seq, n):
    out = list(seq)
    for i in RANDOM.sample(range(len(out)), n):
        out[i] = RANDOM.choice([b for b in "ACGT" if b != out[i]])
    return "".join(out)


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def family(roots=6, copies=7, length=100):
    out = []
    for _ in range(roots):
        root = "CCAGCAGCCGCGGTAA" + dna(length - 16)
        out += [root] + [mutated(root, RANDOM.randint(1, 6)) for _ in range(copies)]
    return list(dict.fromkeys(out))


def frame(spark, seqs):
    return spark.createDataFrame([("g", f"s{i:03d}", s, 1 + (len(seqs) - i) ** 2) for i, s in enumerate(seqs)], "g string, id string, seq string, size long")


def test_pairs_are_complete(spark):
    seqs = family()
    got = {(r.q, r.t): r.edits for r in Y.similar_pairs(frame(spark, seqs), frame(spark, seqs), ["g"], 0.97, same=True).collect()}
    want = {(f"s{i:03d}", f"s{j:03d}"): d for i, a in enumerate(seqs) for j, b in enumerate(seqs) if i != j and (d := edits(a, b)) <= 3}
    assert got == want


def test_conserved_words_bring_no_candidates(spark):
    """Short sequences behind one primer: two words of 16 letters, one of them the primer's, must not pair them all."""
    seqs = ["CCAGCAGCCGCGGTAA" + dna(24 + i % 24) for i in range(150)]
    seqs += [seqs[0][:-1], seqs[1][:20] + "A" + seqs[1][20:], mutated(seqs[2], 1)]
    table = frame(spark, seqs)
    assert Y.candidates(table, table, ["g"], 0.97, same=True).count() < 3 * len(seqs)
    got = {(r.q, r.t): r.edits for r in Y.similar_pairs(table, table, ["g"], 0.97, same=True).collect()}
    allowed = lambda a, b: int(max(len(a), len(b)) * (1 - 0.97) + 1e-9)
    assert got == {(f"s{i:03d}", f"s{j:03d}"): d for i, a in enumerate(seqs) for j, b in enumerate(seqs) if i != j and abs(len(a) - len(b)) < 4 and (d := edits(a, b)) <= allowed(a, b)}


def test_pairs_with_as_many_edits_as_words(spark):
    """An edit in each word of 16 letters leaves no such word whole, yet the pair counts."""
    seqs = [dna(n) for n in (12, 20, 33, 40, 40, 75, 111)]
    flip = str.maketrans("ACGT", "CATG")
    for s in seqs[:]:
        spots = range(7, len(s), 16)
        seqs += ["".join(c.translate(flip) if i in spots else c for i, c in enumerate(s)), s[:8] + s[9:]]
    table = frame(spark, seqs)
    got = {(r.q, r.t): r.edits for r in Y.similar_pairs(table, table, ["g"], 0.9, same=True).collect()}
    want = {(f"s{i:03d}", f"s{j:03d}"): d for i, a in enumerate(seqs) for j, b in enumerate(seqs) if i != j and (d := edits(a, b)) <= int(max(len(a), len(b)) * (1 - 0.9) + 1e-9)}
    assert got == want
    parent, child = seqs[3], seqs[3][:7] + seqs[3][7].translate(flip) + seqs[3][8:23] + seqs[3][23].translate(flip) + seqs[3][24:]
    rows = [("g", "parent", parent, 640), ("g", "child", child, 20)]
    out = Y.denoise(spark.createDataFrame(rows, "g string, id string, seq string, size long"), ["g"]).collect()
    assert [(r.id, r["size"]) for r in out] == [("parent", 660)]


def test_greedy_clusters_equal_the_sequential_algorithm(spark):
    seqs = family()
    got = {r.id: r.centroid for r in Y.cluster_otus(frame(spark, seqs), ["g"]).collect()}
    centroids, want = [], {}
    for i, s in enumerate(seqs):
        near = [(edits(s, seqs[c]), c) for c in centroids if edits(s, seqs[c]) <= 3]
        want[f"s{i:03d}"] = f"s{min(near)[1]:03d}" if near else f"s{i:03d}"
        if not near:
            centroids.append(i)
    assert got == want


def test_denoise_merges_errors_and_keeps_reads(spark):
    true = [dna(120) for _ in range(4)]
    rows = [("g", f"t{i}", s, 1000) for i, s in enumerate(true)] + [("g", f"e{i}{k}", mutated(s, 1), 3) for i, s in enumerate(true) for k in range(5)] + [("g", "single", dna(120), 1)]
    out = Y.denoise(spark.createDataFrame(rows, "g string, id string, seq string, size long"), ["g"]).collect()
    assert sorted(r.id for r in out) == ["t0", "t1", "t2", "t3"]
    assert sum(r["size"] for r in out) == 4000 + 60


def test_error_model_finds_variants_that_errors_do_not_explain(spark):
    true = [dna(100) for _ in range(2)]
    variant = mutated(true[0], 1)
    rows = [("g", "t0", true[0], 2000), ("g", "t1", true[1], 1500), ("g", "v0", variant, 600)]
    rows += [("g", f"e{i}{k}", s, RANDOM.randint(1, 3)) for i, t in enumerate(true) for k in range(40) if (s := mutated(t, 1)) != variant]
    rows = list({r[2]: r for r in reversed(rows)}.values())
    found = E.denoise(spark.createDataFrame(rows, "g string, id string, seq string, size long"), ["g"])
    got = {r.id: r.reads for r in E.variants(found, ["g"]).collect()}
    assert set(got) == {"t0", "t1", "v0"}
    assert sum(got.values()) == sum(r[3] for r in rows)
    assert {r.centre for r in found.where("id like 'e1%'").collect()} == {"t1"}


def test_abundance_probability():
    assert E.abundance_p(1, 0.5) == 1.0
    assert abs(E.abundance_p(2, 0.5) - (1 - 1.5 * 2.718281828459045**-0.5) / (1 - 2.718281828459045**-0.5)) < 1e-12
    assert E.abundance_p(50, 0.01) < 1e-100
    assert E.abundance_p(5, 0.0) == 0.0


def test_chimeras(spark):
    a, b = dna(100), dna(100)
    rows = [("g", "a", a, 100), ("g", "b", b, 90), ("g", "c", a[:40] + b[40:], 10), ("g", "d", dna(100), 10), ("g", "weak", a[:50] + b[50:], 80)]
    found = {r.id: (r.chimera, r.parent_a, r.parent_b) for r in Y.chimeras(spark.createDataFrame(rows, "g string, id string, seq string, size long"), ["g"]).collect()}
    assert found == {"a": (False, None, None), "b": (False, None, None), "c": (True, "a", "b"), "d": (False, None, None), "weak": (False, None, None)}


def test_only_sequences_that_share_a_half_with_a_parent_are_cut(spark, monkeypatch):
    """Singletons that share nothing but a primer are left out before parts of all lengths are made."""
    a, b = dna(100), dna(100)
    rows = [("g", "a", a, 100), ("g", "b", b, 90), ("g", "c", a[:70] + b[70:], 10), ("g", "e", a[:30] + b[30:], 10)] + [("g", f"x{i}", a[:16] + dna(84), 1) for i in range(60)]
    kept = {}
    monkeypatch.setattr(Y, "stage", lambda df, tag: kept.setdefault(tag, stage(df, tag)))
    found = Y.chimeras(spark.createDataFrame(rows, "g string, id string, seq string, size long"), ["g"])
    assert {r.id: (r.parent_a, r.parent_b) for r in found.where("chimera").collect()} == {"c": ("a", "b"), "e": ("a", "b")}
    assert found.count() == len(rows)
    assert {r.id for r in kept["chimera-open"].collect()} == {"c", "e"}
    assert kept["chimera-front"].count() <= 4 * 100


def test_reads_count_for_their_best_centroid(spark):
    a, b = dna(100), dna(100)
    reads = [("g", "S1", a), ("g", "S1", a), ("g", "S1", mutated(a, 2)), ("g", "S2", b), ("g", "S2", dna(100))]
    got = Y.map_reads(spark.createDataFrame(reads, "g string, sample_id string, seq string"), frame(spark, [a, b]), ["g"]).collect()
    assert {(r.feature_id, r.sample_id): r["count"] for r in got} == {("s000", "S1"): 3, ("s001", "S2"): 1}


def test_short_reads_behind_a_primer_are_mapped(spark):
    """Reads of 40 letters behind a primer, most without a centroid: counts by all pairs, without pairing them all."""
    centroids = ["CCAGCAGCCGCGGTAA" + dna(24) for _ in range(20)]
    reads = [("g", f"S{i % 3}", (centroids[i % 20].lower() if i % 2 else mutated(centroids[i % 20], 1)) if i % 4 < 2 else "CCAGCAGCCGCGGTAA" + dna(24)) for i in range(120)]
    table = spark.createDataFrame(reads, "g string, sample_id string, seq string")
    want = {}
    for _, sample, seq in reads:
        near = [i for i, c in enumerate(centroids) if edits(c, seq.upper()) <= 1]
        if near:
            key = (f"s{min(near, key=lambda i: edits(centroids[i], seq.upper())):03d}", sample)
            want[key] = want.get(key, 0) + 1
    assert {(r.feature_id, r.sample_id): r["count"] for r in Y.map_reads(table, frame(spark, centroids), ["g"]).collect()} == want
    unique = table.select("g", F.md5(F.upper("seq")).alias("id"), F.upper("seq").alias("seq")).distinct()
    assert Y.candidates(unique, frame(spark, centroids), ["g"], 0.97).count() < 2 * unique.count()


def test_pairs_merge_to_their_fragment(spark):
    back = str.maketrans("ACGT", "TGCA")
    rows, want = [], {}
    for i in range(40):
        whole = dna(RANDOM.randint(30, 95))
        first, second = whole[:60], whole.translate(back)[::-1][:60]
        rows.append((i, first, second, "I" * len(first), "I" * len(second)))
        want[i] = whole
    pairs = spark.createDataFrame(rows, "k int, seq1 string, seq2 string, qual1 string, qual2 string")
    assert {r.k: r.seq for r in Q.merge_pairs(pairs).collect()} == want
    adapters = pairs.withColumns({"seq1": F.concat(F.left("seq1", F.lit(30)), F.lit("GATCGG")), "seq2": F.lit("A" * 60)})
    assert Q.without_adapters(adapters).count() == 40


def test_orientation_and_taxonomy(spark):
    refs = [(dna(150), f"d__B;p__{i // 2};g__{i}") for i in range(6)]
    references = spark.createDataFrame(refs, "seq string, taxon string")
    seqs = [("fwd", refs[0][0][10:120]), ("rev", refs[3][0][10:120].translate(str.maketrans("ACGT", "TGCA"))[::-1]), ("none", dna(12))]
    turned = N.oriented(spark.createDataFrame(seqs, "id string, seq string"), references)
    assert {r.id: r.seq for r in turned.collect()} == {"fwd": seqs[0][1], "rev": refs[3][0][10:120]}
    found = {r.id: r.taxon for r in N.classify(turned.select("id", "seq"), N.train(references)).collect()}
    assert found == {"fwd": "d__B;p__0;g__0", "rev": "d__B;p__1;g__3"}


def test_model_comes_to_the_driver_by_numbers(spark, monkeypatch):
    """The names of taxa and words are not repeated for every cell on the driver."""
    refs = [(dna(150), f"d__B;p__{i // 2};g__{i}") for i in range(6)]
    rows, frames = [], type(spark.range(1))
    monkeypatch.setattr(frames, "toPandas", lambda self, own=frames.toPandas: (lambda x: rows.append(len(x)) or x)(own(self)))
    seqs = spark.createDataFrame([(str(i), s[10:120]) for i, (s, _) in enumerate(refs)], "id string, seq string")
    found = {r.id: r.taxon for r in N.classify(seqs, N.train(spark.createDataFrame(refs, "seq string, taxon string"))).collect()}
    assert found == {str(i): t for i, (_, t) in enumerate(refs)}
    assert sum(rows) <= 6 + len({s[i : i + 8] for s, _ in refs for i in range(143)})


def test_nearest_tips_by_all_pairs(spark):
    """Short and long sequences, tips among them, repeats of tips under other names: the tip with the largest share of words."""
    roots = family(4, 5, 60)
    seqs = roots + [r[:n] for r in roots[::3] for n in (11, 12, 15, 30)] + [roots[0], roots[0] + "ACGTACGTTT", dna(80)]
    named = [(f"s{i:03d}", s) for i, s in enumerate(seqs)]
    tips = [x for x in named if int(x[0][1:]) % 2 == 0] + [("r0", roots[0]), ("long", roots[0] + dna(30))]
    words = lambda s: {s[i : i + 12] for i in range(len(s) - 11)}
    want = {}
    for name, s in named:
        shares = [(-len(words(s) & words(t)) / len(words(s)), tip) for tip, t in tips] if words(s) else []
        if shares and min(shares)[0] <= -0.5:
            want[name] = (min(shares)[1], round(-min(shares)[0], 6))
    found = N.place_near(spark.createDataFrame(named, "id string, seq string"), spark.createDataFrame(tips, "id string, seq string"))
    assert {r.feature_id: (r.tip, r.share) for r in found.collect()} == want


def test_closed_reference(spark):
    draw = random.Random(6)
    true = ["".join(draw.choice("ACGT") for _ in range(100)) for _ in range(3)]
    refs = spark.createDataFrame([(f"r{i}", s, f"d__{i}") for i, s in enumerate(true)], "id string, seq string, taxon string")
    reads = [("S1", k, (true[k % 3][:50] + "A" + true[k % 3][51:]) if k % 2 else true[k % 3]) for k in range(12)] + [("S2", 99, "A" * 100)]
    frame = spark.createDataFrame(reads, "sample_id string, read_idx long, seq string")
    table, taxa = N.closed_reference(frame, refs, tips=spark.createDataFrame([("r0",), ("r1",)], "feature_id string"))
    assert {(r.feature_id, r.sample_id): r["count"] for r in table.collect()} == {("r0", "S1"): 4, ("r1", "S1"): 4}
    assert {r.feature_id: r.taxon for r in taxa.collect()} == {"r0": "d__0", "r1": "d__1"}
