"""Fill-in-middle, vector codes and line dedup, against brute force, round trips and fresh builds."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.llm import fill_middle, line_dedup, queries, vector_codes

DOCS = "doc_id long, text string, n long, form string, key string, id long, keys string, __text string, slots int"
UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"


def table(spark, rows):
    return spark.createDataFrame([(i, t, 1, "clash", "clash", 1, "clash", "clash", 1) for i, t in rows], DOCS)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# -- fill-in-middle


def cut_by_regex(doc_id, text, rate=50):
    text = text or ""
    units, hexed = UNIT.findall(text), sha(f"42:{'' if doc_id is None else doc_id}")
    n, h = len(units), [int(hexed[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, None, text
    if h[3] % 100 < 80:
        return n, "spm", len(p), len(m), len(s), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), len(s), f"<P>{p}<S>{s}<M>{m}"


def odd_texts(seed, count):
    rng = random.Random(seed)
    parts = ["a", "ß", "日本", "😀", " ", "\t", "\n", "\x0b", " ", "<P", ">", "<S", "M>", "word ", "é"]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(0, 60))) for _ in range(count)]


@pytest.mark.parametrize("block", [1, 3, 8, 4096])
def test_tree_finds_every_cut(block):
    for text in odd_texts(block, 40) + ["", " ", "a", "a ", " a"]:
        units, tree = UNIT.findall(text), fill_middle.TextTree(text.encode(), block)
        assert tree.units == len(units)
        for k in range(len(units) + 1):
            before = "".join(units[:k])
            assert tree.cut(k) == (len(before.encode()), len(before))


@pytest.mark.parametrize("block", [5, 4096])
def test_fill_in_middle_equals_regex(spark, block):
    rows = [(i, t) for i, t in enumerate(odd_texts(1, 150))]
    rows += [(900, None), (901, ""), (902, " \n"), (903, "x <M> y"), (None, "null id here"), (None, None), (3, rows[3][1]), (3, rows[3][1]), (904, "läng " * 300_000)]
    cut = fill_middle.fill_in_middle(table(spark, rows), block=block, rate=90)
    got = cut.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "suffix_chars", "output", fill_middle.restored(F.col("output"), F.col("form")).alias("back")).collect()
    want = [(i, *cut_by_regex(i, t, 90), t or "") for i, t in rows]
    assert sorted(map(repr, (tuple(r) for r in got))) == sorted(map(repr, want))
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_fill_in_middle_of_nothing(spark):
    assert fill_middle.fill_in_middle(table(spark, [])).collect() == []


# -- vector codes


def codes_by_search(rows, entries, rounds, parts=4):
    """Kept (id, label, vector) rows in order -> (codes, errors, codebooks), all entries searched with whole numbers of any size."""
    ints = [[int(np.floor(1024 * x)) for x in v] for _, _, v in rows]
    width = len(ints[0]) // parts
    split = [[v[p * width : p * width + width] for v in ints] for p in range(parts)]
    books = [[list(v) for v in split[p][:entries]] for p in range(parts)]

    def nearest(v, book):
        return min((sum((a - b) ** 2 for a, b in zip(v, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            found = [nearest(v, books[p])[1] for v in split[p]]
            for k in range(len(books[p])):
                own = [v for v, f in zip(split[p], found) if f == k]
                if own:
                    books[p][k] = [sum(c) // len(own) for c in zip(*own)]
    final = [[nearest(v, books[p]) for v in split[p]] for p in range(parts)]
    return ["".join(f"{final[p][i][1]:02x}" for p in range(parts)) for i in range(len(ints))], [sum(final[p][i][0] for p in range(parts)) for i in range(len(ints))], books


def vectors(spark, rows):
    return spark.createDataFrame([(i, l, v, "clash", 1) for i, l, v in rows], "vec_id long, label int, embedding array<double>, code string, __v int")


@pytest.mark.parametrize("scale, entries", [(0.4, 12), (0.01, 12), (900.0, 5), (0.4, 256)])
def test_vector_codes_equal_full_search(spark, scale, entries):
    rng = np.random.default_rng(3)
    rows = [(i, int(rng.integers(0, 4)) if i % 9 else None, (rng.normal(0, scale, 8) + 3 * scale * rng.integers(0, 3)).tolist()) for i in range(120)]
    rows += [(200 + i, 1, rows[7][2]) for i in range(30)]  # one vector in many rows, ties between equal entries
    rows = [(i, l, rows[1][2] if i in (3, 5) else v) for i, l, v in rows]
    bad = [(1000, 1, None), (1001, 1, []), (1002, 1, [1.0] * 7 + [None]), (1003, 2, [float("nan")] * 8), (1004, 2, [float("-inf")] + [0.0] * 7), (1005, 2, [1.0] * 4)]
    kept, books = vector_codes.vector_codes(vectors(spark, [*rows[::-1], *bad]).repartition(5), entries=entries)
    codes, errors, want = codes_by_search(rows, entries, 4)
    by_label = {}
    for (_, label, _), e in zip(rows, errors):
        by_label[label] = by_label.get(label, 0) + e
    got = {r.vec_id: (r.label, r.code, r.error, r.label_error) for r in kept.collect()}
    assert got == {i: (l, c, e, by_label[l]) for (i, l, _), c, e in zip(rows, codes, errors)}
    assert [b.tolist() for b in books] == want


def test_balls_equal_full_search():
    rng = np.random.default_rng(8)
    for spread in (1, 40, 4000, 10**8):
        centres = rng.integers(-spread, spread + 1, (40, 4))
        x = centres[rng.integers(0, 40, 3000)] + rng.integers(-3, 4, (3000, 4))
        balls = vector_codes.Balls(centres)
        full = np.array([[sum((int(a) - int(b)) ** 2 for a, b in zip(v, c)) for c in centres] for v in x[:300]])
        code, error = balls.first(x)
        assert (code[:300] == full.argmin(1)).all() and (error[:300] == full.min(1)).all()
        for held in (code, rng.integers(0, 40, len(x))):
            again = balls.again(x, held)
            assert (again[0] == code).all() and (again[1] == error).all()


def test_vector_codes_of_odd_tables(spark):
    none, books = vector_codes.vector_codes(vectors(spark, [(1, 1, None)]))
    assert none.collect() == [] and [len(b) for b in books] == [0] * 4
    five, books = vector_codes.vector_codes(vectors(spark, [(None, None, [1.0, 2.0, 3.0, 4.0, 5.0]), (2, 1, [1.0] * 5), (2, 1, [1.0] * 5)]))  # lengths that four does not divide
    assert sorted(r.code for r in five.collect()) == ["00000000", "00000000", "02020200"] and all(r.error == 0 for r in five.collect())
    assert [b.shape for b in books] == [(3, 2)] * 4
    huge, _ = vector_codes.vector_codes(vectors(spark, [(i, 1, [1e30 * (-1) ** i] * 64) for i in range(3)]), entries=1)
    assert len(huge.collect()) == 3


# -- line dedup


def lines_dropped(rows, least_chars=20, least_docs=3):
    """Rows (id, text), ids distinct -> {id: (n_lines, n_dropped, kept)}; None is the least id."""
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
    order = lambda i: (i is not None, i or 0)
    held = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least_chars:
                held.setdefault(key(line), set()).add(i)
    owner = {k: max(ids, key=order) for k, ids in held.items() if len(ids) >= least_docs}
    out = {}
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [line for line in lines if owner.get(key(line), i) == i]
        out[i] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def corpus(seed, ids):
    rng = random.Random(seed)
    pool = [f"Shared line number {k} of the Corpus" for k in range(25)] + ["ÄÖ line of exactly 20", "short one", "", "   ", "\tÀ line with tabs around it\t"]
    rows = []
    for i in ids:
        lines = [rng.choice(pool) if rng.random() < 0.6 else f"own line {i} {rng.random()}" for _ in range(rng.randrange(1, 12))]
        lines = [rng.choice([line.upper(), line.lower(), f"  {line}\r", line]) if "Shared" in line else line for line in lines]
        rows.append((i, "\n".join([*lines, "this line stands in every document"] if i % 5 else lines)))
    return rows


def cleaned(docs, index, lines):
    return {r.doc_id: (r.n_lines, r.n_dropped, r.kept) for r in line_dedup.dedup_lines(docs, lines, index).collect()}


def test_lines_equal_brute_force(spark):
    rows = corpus(2, range(80)) + [(100, None), (101, ""), (102, "\n\n"), (103, "a line that three documents hold\n" * 4), (104, "a line that three documents hold"), (None, "a line that three documents hold"), (105, "x" * 2_000_000 + "\n" + "y" * 30)]
    docs = table(spark, rows + rows[:3]).repartition(6)  # repeated rows are one document
    lines = line_dedup.document_lines(docs)
    index = line_dedup.build(lines)
    got = line_dedup.dedup_lines(docs, lines, index).collect()
    want = lines_dropped(rows)
    assert sorted(map(repr, ((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in got))) == sorted(map(repr, [(i, *want[i]) for i, _ in rows + rows[:3]]))
    assert sum(w[1] for w in want.values()) > 100


def counts(index):
    return {bytes(r.key): r.docs for r in index.refs.collect()}


def test_inserts_and_deletions_are_reversible(spark):
    rows = corpus(4, range(90))
    first, second, gone = rows[:40], rows[40:], [r for r in rows if r[0] % 3 == 0]
    of = lambda part: line_dedup.document_lines(table(spark, part))
    one = line_dedup.build(of(first))
    both = line_dedup.insert(one, of(second))
    assert counts(both) == counts(line_dedup.build(of(rows)))
    docs = table(spark, rows)
    assert cleaned(docs, both, of(rows)) == lines_dropped(rows)
    left = [r for r in rows if r[0] % 3]
    less = line_dedup.delete(both, of(gone))
    assert counts(less) == counts(line_dedup.build(of(left)))
    assert cleaned(table(spark, left), less, of(left)) == lines_dropped(left)
    back = line_dedup.insert(less, of(gone))
    assert counts(back) == counts(both) and cleaned(docs, back, of(rows)) == lines_dropped(rows)
    none = line_dedup.delete(both, of(rows))
    assert counts(none) == {} and all(not np.frombuffer(f.slots, np.uint16).any() for f in none.filters.collect())
    with pytest.raises(Exception, match="not in the index"):
        line_dedup.delete(one, of(second))


def test_index_grows(spark):
    """Filters that outgrow their shard, and shards that outgrow their number, are made anew."""
    of = lambda rows: line_dedup.document_lines(table(spark, rows))
    shared = lambda ids, top: [(i, "\n".join(f"line {k} that several hold" for k in range(top))) for i in ids]
    rows, more = shared(range(3), 200), shared(range(10, 13), 3000)
    start = line_dedup.build(of(rows))
    for shard_keys in (1 << 16, 1):
        grown = line_dedup.insert(start, of(more), shard_keys)
        assert grown.shards == (64 if shard_keys > 1 else 4096)
        assert cleaned(table(spark, rows + more), grown, of(rows + more)) == lines_dropped(rows + more)


def test_lines_of_nothing(spark):
    docs = table(spark, [])
    lines = line_dedup.document_lines(docs)
    assert line_dedup.dedup_lines(docs, lines, line_dedup.build(lines)).collect() == []


def test_cuckoo_filter():
    rng = np.random.default_rng(1)
    keys = [rng.bytes(16) for _ in range(5000)]
    filt = line_dedup.Cuckoo.of(keys)
    assert filt.holds(keys).all() and np.mean(filt.holds([rng.bytes(16) for _ in range(20000)])) < 0.001
    filt.remove(keys[:2500])
    assert filt.holds(keys[2500:]).all() and filt.holds(keys[:2500]).mean() < 0.01
    assert filt.add(keys[:2500]) and filt.holds(keys).all()
    filt.remove(keys)
    assert not filt.slots.any()
    assert not line_dedup.Cuckoo(4).add(keys[:100])


@pytest.mark.parametrize("name", ["op11_fill_middle", "op12_vector_codes", "op13_line_dedup"])
def test_digests_are_stable(spark, name):
    first, second = (sorted(map(tuple, queries.QUERIES[name](spark, SF).collect())) for _ in range(2))
    assert first == second and first
