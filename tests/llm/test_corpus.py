"""Near copies, leaks, toxicity, quality, mixing and the pipeline, against brute force or held-out labels."""

import collections
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.llm import decontamination, mixing, near_dedup, quality, queries, toxicity
from tidewater.llm.common import lookup

DOCS = "doc_id long, text string, source string, size string"
SF = "/root/testdata/sf0.001"


def table(spark, rows):
    return spark.createDataFrame([(i, t, s, "clash") for i, t, s in rows], DOCS)


def near_classes(rows, k, percent):
    """doc_id -> (set size, component), all pairs compared."""
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()
    up = {i: i for i in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    where = collections.defaultdict(list)
    for i, s in sets.items():
        for x in s:
            where[x].append(i)
    pairs = {(a, b) for own in where.values() for n, a in enumerate(own) for b in own[n + 1 :]}
    for a, b in pairs:
        both = len(sets[a] & sets[b])
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = top(a), top(b)
            up[max(x, y)] = min(x, y)
    return {i: (len(s), top(i)) for i, s in sets.items()}


def noisy(rng, base, share):
    return " ".join(w if rng.random() > share else f"n{rng.randrange(10**6)}" for w in base)


def test_near_copies_equal_brute_force(spark):
    rng = random.Random(5)
    base = [f"w{rng.randrange(500)}" for _ in range(220)]
    rows = [(i, noisy(rng, base, 0.004 * (i % 9))) for i in range(2, 90)]  # one large group, similarities around the limit
    rows += [(100 + i, " ".join(f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(1, 40)))) for i in range(40)]
    rows += [(200, "One two"), (201, "one  TWO"), (202, "one"), (203, None), (204, ""), (205, " \n"), (206, "É b c d"), (207, "é b c d"), (1, rows[5][1])]
    for few in (32, 2):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(table(spark, [(i, t, "s") for i, t in rows]), 4, 80, few=few).collect()}
        assert got == near_classes(rows, 4, 80)


@pytest.mark.parametrize("name, value", [("LONG", 40), ("LONG", 10**6), ("BROADCAST_IDS", 0), ("BROADCAST_IDS", 10**6)])
def test_near_copies_on_both_sides_of_each_switch(spark, monkeypatch, name, value):
    """Sets on both sides of the length at which the keys change, and sets fetched by broadcast and by shuffle."""
    rng = random.Random(12)
    base = [[f"w{rng.randrange(900)}" for _ in range(n)] for n in (30, 44, 52, 160)]
    rows = [(i, noisy(rng, base[i % 4], 0.006 * (i % 7))) for i in range(70)] + [(200 + i, " ".join(f"u{rng.randrange(10**6)}" for _ in range(60))) for i in range(10)]
    monkeypatch.setattr(near_dedup, name, value)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(table(spark, [(i, t, "s") for i, t in rows]), 4, 80, few=4).collect()}
    assert got == near_classes(rows, 4, 80)


@pytest.mark.parametrize("hot", [0, 5000])
def test_lookup_of_hot_and_cold_keys(spark, hot):
    """Keys that are broadcast and keys that are joined give what one join gives; rows without a value keep null."""
    keys = ["hot"] * hot + [f"k{i % 40}" for i in range(400)] + ["none"] * 3
    rows = spark.createDataFrame(list(enumerate(keys)), "n long, key string")
    values = rows.where("key <> 'none'").groupBy("key").agg(F.count("*").alias("uses"), F.max("n").alias("last"))
    got = lookup(rows, values, "key", "uses")
    want = rows.join(values, "key", "left").select(*got.columns)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect())) and got.count() == len(keys)


def test_near_copies_of_odd_tables(spark):
    df = table(spark, [(5, "a b c d e f", "s"), (5, "a b c d e f", "s"), (None, "a b c d e f", "s"), (6, "A b c d e f", "s")])
    got = sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in near_dedup.near_duplicates(df, 4, 80).collect())
    assert got == [(0, 0, True), (5, 5, True), (5, 5, True), (6, 5, False)]
    assert near_dedup.near_duplicates(df.limit(0), 4, 80).count() == 0
    assert near_dedup.drop_near_copies(df).columns == df.columns


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (102, 101), (103, 102), (200, 201)]
    for alone in (1000, 0):
        got = {r.id: r.component for r in near_dedup.components(spark.createDataFrame(edges, "a long, b long"), alone).collect()}
        assert got == {**{i: 1 for i in range(2, 41)}, 101: 100, 102: 100, 103: 100, 201: 200}


def test_keys_meet_within_the_guaranteed_distance():
    rng = np.random.default_rng(0)
    for _ in range(200):
        a = rng.integers(0, 2**16, near_dedup.SKETCH, dtype=np.uint64)
        b = a.copy()
        at = rng.choice(near_dedup.SYMBOLS, 2 * near_dedup.CHUNKS - 1, replace=False)
        b[at] = rng.integers(0, 2**16, len(at), dtype=np.uint64)
        assert set(near_dedup.chunk_keys(a)) & set(near_dedup.chunk_keys(b))


# --- leaks


def test_leaks(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice(["th", "er", "on", "ba", "mi"]) for _ in range(rng.randrange(1, 5)))
    items = [(i, " ".join(word() for _ in range(25))) for i in range(30)]
    clean = [(i, " ".join(word() for _ in range(200)), "s") for i in range(60)]
    planted = [(100 + i, clean[i][1][:300] + " " + t.upper() + "!!! " + clean[i][1][300:], "s") for i, t in items]
    swapped = [(200 + i, " ".join(clean[i][1].split()[:90] + [w for n, w in enumerate(t.split()) if n % 9] + clean[i][1].split()[90:]), "s") for i, t in items]
    docs = table(spark, clean + planted + swapped + [(300, None, "s"), (301, "", "s"), (302, items[0][1], "s"), (302, items[0][1], "s"), (302, "of one id", "s"), (None, items[2][1], "s"), (None, "too long", "s"), (303, "it is too short", "s"), (304, "too long, short", "s")])
    bench = spark.createDataFrame([*items, (40, None), (41, "Too, short"), (None, items[1][1])], "item_id long, text string")
    got = [(r.doc_id, [x.item for x in r["items"]]) for r in decontamination.leaks(docs, bench).where("contaminated").collect()]
    assert sorted(got, key=repr) == sorted([(100 + i, [i]) for i in range(30)] + [(200 + i, [i]) for i in range(30)] + [(302, [0])] * 2 + [(303, [41])] + [(None, [2])], key=repr)
    kept = decontamination.drop_contaminated(docs, bench).collect()
    assert {r.doc_id for r in kept} == set(range(60)) | {300, 301, 302, 304, None} and [r.text for r in kept if r.doc_id in (302, None)] == ["of one id", "too long"]
    assert decontamination.leaks(docs, bench.limit(0)).where("contaminated").count() == 0
    assert decontamination.leaks(docs.limit(0), bench).count() == 0
    for settings in ({"block": 12}, {"block_bytes": 700}):  # the same in several blocks
        blocks = decontamination.leaks(docs, bench, **settings)
        assert blocks.where("contaminated").count() == 64 and blocks.count() == docs.count()
        assert sorted(((r.doc_id, [x.item for x in r["items"]]) for r in blocks.where("contaminated").collect()), key=repr) == sorted(got, key=repr)


def test_leaks_of_odd_columns_and_long_texts(spark):
    """Columns of the results' names, equal item texts, and a text of many thousand words that holds an item at its end."""
    rng = random.Random(8)
    said = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(n))
    item = said(20)
    docs = spark.createDataFrame([(1, said(60_000) + " " + item, "x", False), (2, said(50), "y", True)], "doc_id long, text string, items string, contaminated boolean")
    bench = spark.createDataFrame([(1, item, "x"), (2, item, "y")], "item_id long, text string, items string")
    got = {r.doc_id: [x.item for x in r["items"]] for r in decontamination.leaks(docs, bench).collect()}
    assert got == {1: [1, 2], 2: []}
    assert [tuple(r)[2:] for r in decontamination.drop_contaminated(docs, bench).collect()] == [("y", True)]


def test_leaks_of_a_large_benchmark_equal_brute_force(spark):
    rng = random.Random(11)
    words = ["".join(rng.choice(["th", "er", "on", "ba", "mi", "so"]) for _ in range(rng.randrange(2, 6))) for _ in range(3000)]
    said = lambda n: [rng.choice(words) for _ in range(n)]
    items = [said(rng.randrange(15, 60)) for _ in range(1200)]
    texts = [said(rng.randrange(40, 200)) for _ in range(90)]
    for i in range(60):  # verbatim, and without every ninth word
        item = items[i * 20]
        texts[i][30:30] = item if i % 2 else [w for n, w in enumerate(item) if n % 9]
    texts += [items[7], items[8]]
    terms = decontamination.Vocabulary()
    own = [terms.words(" ".join(t).encode()).tolist() for t in texts]
    truth = set()
    for j, item in enumerate(items):
        t = terms.words(" ".join(item).encode()).tolist()
        bits = decontamination.word_bits(t)
        truth |= {(i, j) for i, text in enumerate(own) if decontamination.common_subsequence(bits, len(t), text) >= 0.8 * len(t)}
    assert len(truth) == 62
    docs = table(spark, [(i, " ".join(t), "s") for i, t in enumerate(texts)])
    bench = spark.createDataFrame([(j, " ".join(t)) for j, t in enumerate(items)], "item_id long, text string")
    for settings in ({}, {"held": 0.0, "rank": 1300}, {"held": 2.0}):  # as it comes, all latent, all by terms
        got = {(r.doc_id, x.item) for r in decontamination.leaks(docs, bench, **settings).collect() for x in r["items"]}
        assert got == truth, settings


def test_svd_equals_numpy(spark):
    rng = np.random.default_rng(1)
    dense = np.zeros((40, 60))
    rows = []
    for i in range(40):
        at = rng.choice(60, 8, replace=False)
        dense[i, at] = rng.random(8)
        rows.append(([int(t) for t in at], [float(v) for v in dense[i, at]]))
    used, vectors = decontamination.randomised_svd(spark.createDataFrame(rows, "terms array<int>, weights array<double>").repartition(3), 60)
    _, s, _ = np.linalg.svd(dense)
    assert np.allclose(np.linalg.svd(dense[:, used] @ vectors)[1][:30], s[:30], atol=1e-6)


def test_common_subsequence():
    bits = lambda t: (decontamination.word_bits(t), len(t))
    assert decontamination.common_subsequence(*bits([1, 2, 3, 2]), [2, 1, 3, 9, 2]) == 3
    assert decontamination.common_subsequence(*bits([1]), []) == 0


# --- toxicity and quality


def spoken(rng, words, n):
    return " ".join(rng.choice(words) for _ in range(n))


def labelled(rng, n, bad, plain):
    rows, marks = [], []
    for i in range(n):
        toxic = i % 4 == 0
        text = spoken(rng, plain, 60).split()
        if toxic:
            for _ in range(4):
                text[rng.randrange(60)] = rng.choice(bad)
        rows.append((i, " ".join(text), "s"))
        marks.append((i, int(i % 8 != 1), int(toxic)))
    return rows, marks


PLAIN = ["".join(p) for p in zip("banterolimak" * 30, "odupheristan" * 30, "relgimopatu" * 33, "santimore" * 40, strict=False)]


def test_toxicity_on_held_out_rows(spark):
    rng = random.Random(8)
    rows, marks = labelled(rng, 600, ["scoundrel", "numbskull", "wretch"], PLAIN)
    docs, labels = table(spark, [*rows, (900, None, "s"), (901, "", "s"), (901, "", "s")]), spark.createDataFrame([*marks, (None, 1, 1), (5000, 1, None)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, queries.learnable(labels))
    got = {r.doc_id: r.score for r in toxicity.toxicity_scores(docs, model).collect()}
    held = [(i, t) for i, _, t in marks if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(held) > 80 and np.mean([(got[i] >= 0.5) == t for i, t in held]) > 0.97
    assert got[900] == got[901] < 0.5 and all(0 <= s <= 1 for s in got.values())
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, s in got.items() if s < 0.5}
    none = toxicity.fit(docs, labels.limit(0))
    assert {r.score < 0.5 for r in toxicity.toxicity_scores(docs, none).collect()} == {True}
    assert toxicity.toxicity_scores(docs.limit(0), model).count() == 0


def test_quality_on_held_out_rows(spark):
    rng = random.Random(9)
    rows = [(i, spoken(rng, PLAIN, 50) if i % 3 else "$$ ".join(spoken(rng, PLAIN, 50).upper().split()), "s") for i in range(300)]
    docs = table(spark, [*rows, (900, None, "s"), (901, "", "s")])
    grades = spark.createDataFrame([(i, 2 if i % 3 == 1 else 1 if i % 3 else 0) for i, _, _ in rows if i % 2] + [(None, 1), (1, None)], "doc_id long, grade int")
    model = quality.fit(docs, grades)
    got = {r.doc_id: r for r in quality.grade_documents(docs, model, select_from=1).collect()}
    assert np.mean([got[i].kept == bool(i % 3) for i in range(0, 300, 2)]) > 0.97
    assert all(0 <= r.expected_grade <= 2 for r in got.values()) and got[900].tail_probability == got[901].tail_probability
    assert list(model.thresholds) == sorted(model.thresholds)
    assert quality.grade_documents(docs, quality.fit(docs, grades.limit(0)), select_from=1).count() == 302


# --- mixing


def water(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """Targets by the rounds of the rule: share, stop at the cap, share the excess again."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, open_, left = dict.fromkeys(order, 0.0), set(order), share * sum(sizes.values())
    while left > 1e-9 and open_:
        total, over, spent = sum(w[s] for s in open_), 0.0, left
        for s in list(open_):
            target[s] += spent * w[s] / total
            if target[s] >= most * sizes[s]:
                over += target[s] - most * sizes[s]
                target[s] = most * sizes[s]
                open_.discard(s)
        left = over
    return target


@pytest.mark.parametrize("spread", [1, 40])
def test_mix(spark, spread):
    rng = random.Random(spread)
    sources = ["b", "a", "c", "é", "d", None]
    rows = [(i, spoken(rng, PLAIN, rng.randrange(0, 30) * (spread if i % 6 == 1 else 1)), sources[i % 6]) for i in range(600)] + [(900, None, "a"), (901, " \n", None)]
    docs = table(spark, rows)
    got = mixing.mix(docs).collect()
    assert sorted(got) == sorted(mixing.mix(docs.repartition(7)).collect()) and len(got) == len(rows)
    sizes = collections.Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    want = water(sizes)
    taken = collections.Counter()
    for r in got:
        assert (r.source_size, r.target) == (sizes[r.source], pytest.approx(want[r.source])) and r.taken <= 2 * r["size"] and (not r["size"] or r.taken % r["size"] == 0)
        taken[r.source] += r.taken
    for s in sources:
        assert want[s] - 30 * spread <= taken[s] <= want[s] + 1e-6
    assert all(r.taken >= r["size"] * int(want[r.source] / sizes[r.source]) for r in got if sizes[r.source])
    assert mixing.mix(docs.limit(0)).count() == 0
    kept = mixing.mixed_documents(docs.where("doc_id < 600"))
    assert set(kept.columns) == {*docs.columns, "repeats"} and {r.repeats for r in kept.collect()} <= {1, 2}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_texts_that_fit_fill_what_a_long_one_leaves_open(spark, seed):
    rows = [(i, "word " * 10, "s") for i in range(100)] + [(200 + i, "word " * 300, "s") for i in range(2)] + [(300, "word " * 5000, "t")]
    got = mixing.mix(table(spark, rows), weights=(650, 5000), share=5650 / 6600, seed=seed).where("source = 's'").collect()
    assert 0 <= got[0].target - sum(r.taken for r in got) < 10 and got[0].target == pytest.approx(650)


@pytest.mark.parametrize("seed", range(6))
def test_no_text_that_fits_is_left(spark, seed):
    """What a source leaves open is less than each text that it leaves, and it takes its texts in order, each that fits."""
    rng = random.Random(seed)
    rows = [(i, "word " * rng.choice([1, 2, 3, 5, 8, 40, 90, 200]), rng.choice(["s", "t", None])) for i in range(500)]
    got = collections.defaultdict(list)
    for r in mixing.mix(table(spark, rows), seed=seed, share=0.7).collect():
        got[r.source].append(r)
    keys = {r.id: r.key for r in table(spark, rows).select(F.col("doc_id").alias("id"), mixing.sampling_key(F.col("doc_id"), F.lit(1.0), seed).alias("key")).collect()}
    for own in got.values():
        left = own[0].target - own[0].source_size * int(own[0].target / own[0].source_size)
        first = {}
        for r in sorted(own, key=lambda r: (keys[r.doc_id], r.doc_id)):
            first[r.doc_id] = r["size"] <= left
            left -= r["size"] * first[r.doc_id]
        assert {r.doc_id: r.taken > r["size"] * int(r.target / r.source_size) for r in own} == first


def test_better_documents_come_first_more_often(spark):
    rows = [(i, ("word " * 10) if i % 2 else ("w " * 10), "s") for i in range(2000)] + [(5000 + i, "word " * 10, "t") for i in range(600)]
    got = {r.doc_id: r.taken for r in mixing.mix(table(spark, rows), weights=(1, 9), share=0.5).where("source = 's'").collect()}
    good, bad = sum(got[i] > 0 for i in range(1, 2000, 2)), sum(got[i] > 0 for i in range(0, 2000, 2))
    assert good > 2 * bad > 0


# --- pipeline and queries


def test_pipeline_equals_its_stages_by_brute_force(spark):
    import corpus_pipeline

    out = {r.doc_id for r in corpus_pipeline.run(spark, SF).collect()}
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    calm = {r.doc_id for r in corpus_pipeline.without_toxic(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF).collect()}
    seen: dict[str, int] = {}
    for i in sorted(calm):
        seen.setdefault(" ".join(docs[i].split()), i)
    once = sorted(seen.values())
    classes = near_classes([(i, docs[i]) for i in once], 5, 80)
    rest = [i for i in once if classes[i][1] == i]
    items = [b.text.lower() for b in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaked = {i for i in rest if any(" ".join(t.split()) in " ".join(docs[i].lower().split()) for t in items)}
    left = spark.read.parquet(f"{SF}/documents.parquet").where(F.col("doc_id").isin(sorted(set(rest) - leaked)))
    assert out == {r.doc_id for r in mixing.mix(left).where("taken > 0").collect()} and out


def test_pipeline_of_odd_tables(spark, tmp_path):
    import corpus_pipeline

    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    rng = random.Random(2)
    plain = [(i, spoken(rng, PLAIN, 30), "a" if i % 2 else None) for i in range(20)]
    odd = [(None, "one text without an id here", "a"), (50, None, "a"), (51, "", None), (52, " ", "a"), (3, plain[3][1], "a"), (None, "one  text without an id here", "b")]
    schema = "doc_id long, text string, source string, repeats2 string, key int"
    rows = [(*r, "x", 1) for r in plain + odd]
    for k, given in enumerate((rows, [])):
        where = tmp_path / f"sf{k}"
        spark.createDataFrame(given, schema).write.parquet(str(where / "documents.parquet"))
        for name in ("labels", "benchmark"):
            (where / f"{name}.parquet").symlink_to(tmp_path / f"{name}.parquet")
        got = corpus_pipeline.run(spark, str(where))
        assert got.columns == ["doc_id", "text", "source", "repeats2", "key", "repeats"]
        ids = [r.doc_id for r in got.collect()]
        assert len(ids) == len(set(ids)) and set(ids) <= {*range(20), None} and bool(ids) == bool(given)


def test_mixed_documents_of_odd_rows(spark):
    rows = [(None, "a b c", "s"), (None, "a b c", "s"), (1, "d e", "s"), (1, "f g h", "s"), (2, None, "s"), (3, "x y", None)]
    docs = table(spark, rows)
    got = mixing.mixed_documents(docs, share=1.5)
    want = mixing.mix(docs, share=1.5).where("size > 0").agg(F.sum("taken")).first()[0]
    sizes = got.select((F.size(F.split("text", " ")) * F.col("repeats")).alias("n")).agg(F.sum("n")).first()[0]
    assert sizes == want and got.count() == 5 and {r.doc_id for r in got.collect()} == {None, 1, 3}


def test_quality_selects_on_rows_it_has_not_seen(spark):
    """Of the rated rows that are not learnt from, nearly all good ones are kept and few of low quality."""
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    kept = queries.op7_quality(spark, sf).join(labels.join(queries.learnable(labels), "doc_id", "left_anti"), "doc_id")
    share = {r.quality: r.share for r in kept.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert share[1] >= 0.96 and share[0] <= 0.1, share


def test_mixed_documents_replace_a_column_of_the_result(spark):
    docs = spark.createDataFrame([(1, "a b c", "s", 9), (2, "d e f", "s", 9)], "doc_id long, text string, source string, repeats int")
    got = mixing.mixed_documents(docs)
    assert got.columns == ["doc_id", "text", "source", "repeats"] and {r.repeats for r in got.collect()} <= {1, 2}


def test_queries_cover_their_tables(spark):
    for name in ("op1_html_text", "op2_secret_scan", "op3_token_counts", "op7_quality", "op9_benchmark_leaks"):
        out = queries.QUERIES[name](spark, SF)
        whole = spark.read.parquet(f"{SF}/{'pages' if name.startswith('op1') else 'documents'}.parquet").count()
        assert out.count() == whole or name == "op2_secret_scan"
    tokens = queries.op3_token_counts(spark, SF).agg(F.sum("n_tokens")).first()[0]
    counter = __import__("tidewater.llm.token_counts", fromlist=["x"]).PrefixCounter(queries.vocabulary())
    assert tokens == sum(len(counter.tokenizer.encode(r.text, add_special_tokens=False).ids) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())


def test_growing_joins_of_near_copies_are_not_broadcast(spark):
    """Also where a side is small: each broadcast would stay with the driver for a while, and there are dozens."""
    reps = spark.createDataFrame([(k, 10, [k] * 24) for k in range(4)], "node long, n long, symbols array<long>")
    pairs = spark.createDataFrame([(0, 1), (1, 2)], "a long, b long")
    members, hubs = near_dedup.to_hubs(spark.createDataFrame([(7, 0), (7, 1), (8, 2)], "key long, node long"))
    assert sorted(map(tuple, hubs.collect())) == [(0, 1)]
    for out in (near_dedup.likely(pairs, reps, 80), near_dedup.to_draws(members.selectExpr("key", "node", "node as component", "0L as top"))):
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_near_copies_run_few_jobs(spark):
    """Steps count as they write, and none follows one that linked nothing: each job leaves threads and plans with the driver for a while."""
    words = [f"w{k}" for k in range(40)]
    rows = [(k, " ".join([*words[: 40 - k % 2], "x" * (k // 2 + 1)])) for k in range(4)] + [(9, " ".join(reversed(words)))]
    spark.sparkContext.setJobGroup("few-jobs", "near copies")
    try:
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(table(spark, [(i, t, "s") for i, t in rows]), 4, 80).collect()}
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert got == near_classes(rows, 4, 80) and {c for _, c in got.values()} == {0, 9}
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("few-jobs")) <= 50
