"""Page text, token counts, exact copies, secrets, preferences: small cases and exact checks."""

import hashlib
import random
import re

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import Observation, functions as F

from tidewater.llm import exact_dedup, html_text, preferences, queries, secrets, token_counts

DOCS = "doc_id long, text string, source string, kept string"


# --- page text


def page_texts(spark, rows, **settings_):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r.page_id: r.text for r in html_text.main_text(df, **settings_).collect()}


def test_article_without_furniture(spark):
    page = (
        '<html><head><title>T</title><script>var a="</p>"</script></head><body class="has-sidebar"><nav><a>menu</a></nav><div class="cookie-notice">cookies</div><article><header><h1>Head &amp; more</h1></header>'
        "<p>One  <b>two\n<a href=x>three</a>&nbsp;four.<br>five<p>Next<form>mail</form><aside>side</aside><section id=comments><p>me too</p></section><ul><li>a<li>b</ul></article><footer>foot</footer>"
    )
    got = page_texts(spark, [(1, "http://h/1", page), (2, "http://h/2", None), (3, None, ""), (4, "x", "<article><p>cut &am"), (5, "x", "<article>whole <p"), (5, "x", "<article>whole <p")])
    assert got == {1: "Head & more\nOne two three four. five\nNext\na\nb", 2: "", 3: "", 4: "cut &am", 5: "whole"}


def test_names_within_an_article_decide_only_as_a_whole(spark):
    kept = '<p class="notice-period">The notice period is a year.</p><section class="discussion">We discuss.</section><div class="search-results">Found.</div><blockquote class="comment-quote">Said.</blockquote>'
    gone = '<div class="share-bar">tweet</div><div class="newsletter-signup-box">mail me</div><section class="comments">me too</section><ul class="related-links"><li>more</ul>'
    page = f"<body><article><h1>Head</h1>{kept}{gone}</article></body>"
    assert page_texts(spark, [(1, "http://h/1", page)]) == {1: "Head\nThe notice period is a year.\nWe discuss.\nFound.\nSaid."}


def test_an_article_below_a_wrapper_with_a_furniture_word(spark):
    text = "<p>One sentence of the article.</p><p>And one more of it.</p>"
    wraps = ["content-sidebar-wrap", "layout sidebar-right", "main-menu-page", "related-stories-layout", "notice-board"]
    pages = [(i, "http://h/", f'<body><div class="{w}"><nav>menu</nav><p>beside</p><article>{text}<div class="notice">We use cookies</div></article><div class="widget">more</div></div></body>') for i, w in enumerate(wraps)]
    pages += [(20 + i, "http://h/", f'<body><main class="content">{text}</main><div class="{w}"><article>short teaser</article></div></body>') for i, w in enumerate(("related-stories", "sidebar"))]
    pages += [(30, "http://h/", f'<body><article>{text}</article><div class="comments"><article>{"me too " * 40}</article></div></body>')]
    got = page_texts(spark, pages)
    assert set(got.values()) == {"One sentence of the article.\nAnd one more of it."} and len(got) == 8


def test_furniture_and_text_within_an_article(spark):
    gone = "".join(f'<div class="{n}">gone</div>' for n in ("notice", "notice-box", "search-box", "replies", "responses"))
    kept = "<p>Press <label>the key</label> and <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds.</p><p>cut &am<b>p; here</b></p>"
    assert page_texts(spark, [(1, "http://h/1", f"<article>{gone}{kept}</article>")]) == {1: "Press the key and x=1 holds.\ncut &amp; here"}


def test_deep_pages_and_odd_columns(spark):
    deep = "<div>" * 20_000 + "</b>" * 20_000 + "<article><p>text</p></article>"
    long_ = "<article>" + "<p>many words in a page</p>" * 20_000 + "</article>"
    df = spark.createDataFrame([(1, "http://h/1", deep, 5, "a"), (2, "http://h/2", long_, 6, "b")], "page_id long, url string, html string, n_chars int, text string")
    got = {r.page_id: r for r in html_text.main_text(df).collect()}
    assert got[1].text == "text" and got[2].n_chars == 20_000 * 21 - 1


def test_repeats_across_a_host_are_boilerplate_and_unique_runs_stay(spark):
    shared = "<div>all rights are kept by the owner of this site</div>"
    rows = [(i, f"http://h/{i}", f"<body><div>unique {i} text {i} number {i} of {i} the {i} page</div>{shared}</body>") for i in range(5)] + [(9, "http://other/", f"<body>{shared}</body>")]
    got = page_texts(spark, rows)
    assert got[3] == "unique 3 text 3 number 3 of 3 the 3 page"
    assert got[9] == "all rights are kept by the owner of this site"
    copies = page_texts(spark, [(i, "http://h/", "<body><p>one page that stands here under many numbers</p></body>") for i in range(6)])
    assert set(copies.values()) == {"one page that stands here under many numbers"}


def test_repeats_decide_beside_articles_and_within_main(spark):
    teaser = "<article><p>read our other story</p></article>"
    text = lambda i: " ".join(f"w{i}x{k}" for k in range(40))
    shared = "<div>all rights are kept by the owner of this site</div>"
    beside = [(i, f"http://a/{i}", f"<body><div>{text(i)}</div>{shared}{teaser}</body>") for i in range(5)]
    within = [(10 + i, f"http://b/{i}", f"<main><div>{text(i)}</div>{shared}</main>") for i in range(5)]
    named = [(20 + i, f"http://c/{i}", f"<div class=content><p>{text(i)}</p>{shared}</div>") for i in range(5)]
    quoted = [(30 + i, f"http://d/{i}", f"<main><article><p>{text(i)}</p>{shared}</article></main><div>one more word {i}</div>") for i in range(5)]
    copied = [(40 + i, f"http://e/{i}", f"<main><p>one page that stands here under many numbers</p></main><nav>{i}</nav>") for i in range(5)]
    got = page_texts(spark, beside + within + named + quoted + copied)
    assert got == page_texts(spark, beside + within + named + quoted + copied, broadcast_rows=0)  # repeats by shuffle give the same
    for i in range(5):
        assert got[i].split("\n") == [text(i), "read our other story"]
        assert got[10 + i] == got[20 + i] == text(i)
        assert got[30 + i].split("\n") == [text(i), "all rights are kept by the owner of this site"]
        assert got[40 + i] == "one page that stands here under many numbers"


def test_suffix_prefixes_are_the_long_repeats():
    rng = random.Random(4)
    words = [[rng.choice("abc") for _ in range(60)] for _ in range(3)]
    depth = 6
    for own in words:
        others = [w for w in words if w is not own]
        covered = set()
        for i in range(len(own)):
            for j in range(i + depth, len(own) + 1):  # every substring, not only those of the depth
                if any(own[i:j] == w[k : k + j - i] for w in others for k in range(len(w))):
                    covered |= set(range(i, j))
        seen = {p for w in others for p in html_text.prefixes(w, depth)}
        assert covered == {k + d for k, p in enumerate(html_text.prefixes(own, depth)) if p in seen for d in range(depth)}


def test_empty_pages(spark):
    assert page_texts(spark, []) == {}


# --- token counts


@pytest.fixture(scope="module")
def counter():
    return token_counts.PrefixCounter(queries.vocabulary())


SAMPLES = ["", " ", "a  b", "\n\n x", "it's we'll I'M  don't", "Ünïcödé  日本語 １２３  x y", "a\x1cb \x85c", "\n\n\x1cb", "x <|endoftext|> y<|endoftext|>", "1234567 abc123!!!  ...", "tabs\t\tand\r\nlines \n", "é \U0001f600\U0001f468‍\U0001f469"]


def of_library(counter, text):
    return [len(counter.tokenizer.encode(text[: k + 1], add_special_tokens=False).ids) for k in range(len(text))]


def test_counts_equal_the_library_on_every_prefix(counter):
    runs = ["".join(random.Random(k).choice("ab c\n'é日1!-_aeiou") for _ in range(80)) for k in range(60)] + ["a" * 90, " " * 40 + "x" + " " * 40, "=" * 70 + "\n" * 20 + "y"]
    for text in SAMPLES + runs:
        want = of_library(counter, text)
        assert counter.counts(text).tolist() == want, text
        for limit in range(max(want, default=0)):
            assert token_counts.fitting(counter.counts(text), limit) == max([0, *[e + 1 for e, n in enumerate(want) if n <= limit]]), (text, limit)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_counts_equal_the_library(counter, text):
    want = of_library(counter, text)
    assert counter.counts(text).tolist() == want
    for limit in range(len(text)):
        assert token_counts.fitting(counter.counts(text), limit) == max([0, *[e + 1 for e, n in enumerate(want) if n <= limit]])


def test_longest_prefix_within_a_limit(spark):
    """Spaces come in tokens of many, so a longer prefix may have fewer tokens."""
    texts = ["x" + " " * 15 + "y", "a" * 3000, "internationalisation of words", "<|endoftext|> a <|endoftext|>", "é日" * 50]
    df = spark.createDataFrame([(k, t, "s", "x") for k, t in enumerate(texts)], DOCS)
    counter = token_counts.PrefixCounter(queries.vocabulary())
    for limit in (0, 1, 2, 3, 30):
        want = {k: max([0, *[e + 1 for e, n in enumerate(of_library(counter, t)) if n <= limit]]) for k, t in enumerate(texts)}
        assert {r.doc_id: r.fit_chars for r in token_counts.token_counts(df, queries.vocabulary(), limit).collect()} == want


def test_what_is_held_is_bounded(counter):
    """With room for a few entries only, the counts are the same."""
    small = token_counts.PrefixCounter(queries.vocabulary(), units=3, nodes=20, pairs=5)
    rng = random.Random(9)
    for _ in range(40):
        text = " ".join("".join(rng.choice("abcdetion'é.,1") for _ in range(rng.randrange(1, 14))) for _ in range(12))
        assert small.counts(text).tolist() == counter.counts(text).tolist() == of_library(counter, text)
    for memo in (small.units, small.stands):
        assert len(memo.young) + len(memo.old) <= 10
    assert small.nodes <= 20


def test_plain_words_are_counted_side_by_side(counter):
    """No word of letters and signs is walked through by itself, also with room for one pair; all prefixes are the library's."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdetionßéñ") for _ in range(rng.randrange(1, 15))) + rng.choice(["", "", ",", ".***", "!&&"])
    texts = [rng.choice([" ", "\n", "\t"]).join(word() for _ in range(30)) for _ in range(20)] + ["", "x", "\na", "the <|endoftext|> end", "a\n b  c"]
    want = [of_library(counter, t) for t in texts]
    for pairs in (1, 200_000):
        own = token_counts.PrefixCounter(queries.vocabulary(), pairs=pairs)
        walked, walk = [], own.word
        own.word = lambda mapped, walked=walked, walk=walk: walked.append(mapped) or walk(mapped)
        assert [token_counts.counts_of(s).tolist() for s in own.all_steps(texts[:23])] == want[:23]
        assert not walked
        assert [token_counts.counts_of(s).tolist() for s in own.all_steps(texts)] == want


def test_very_long_texts_and_clashing_columns(spark):
    """A run of a megabyte without white space, words of every kind, and columns of the results' names."""
    texts = ["ab1é" * 60_000, "word, " * 100_000, " " * 5000 + "x"]
    df = spark.createDataFrame([(i, t, 7, "clash", b"x") for i, t in enumerate(texts)], "doc_id long, text string, n_tokens int, __id string, steps binary")
    vocabulary = token_counts.PrefixCounter(queries.vocabulary())
    want = {i: len(vocabulary.tokenizer.encode(t, add_special_tokens=False).ids) for i, t in enumerate(texts)}
    assert {r.doc_id: r.n_tokens for r in token_counts.token_counts(df, queries.vocabulary()).collect()} == want


def test_token_table(spark):
    df = spark.createDataFrame([(1, None, "s", "x"), (2, "", "s", "x"), (3, "word " * 600, "s", "x"), (3, "word " * 600, "s", "x"), (None, "hi", "s", "x")], DOCS)
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit, r.fit_chars) for r in token_counts.token_counts(df, queries.vocabulary()).collect())
    assert got[:3] == [(0, 2, 1, False, 2), (1, 0, 0, False, 0), (2, 0, 0, False, 0)]
    assert got[3] == got[4] == (3, 3000, 601, True, 512 * 5 - 1)
    stored = token_counts.prefix_table(df, queries.vocabulary())  # once counted, any number of budgets is asked of the table
    assert {r.doc_id: r.fit_chars for r in token_counts.asked(stored, [512, 1, 0]).collect()} == {1: [0, 0, 0], 2: [0, 0, 0], 3: [512 * 5 - 1, 5 - 1, 0], None: [2, 2, 0]}
    assert token_counts.token_counts(df.limit(0), queries.vocabulary()).count() == 0


# --- exact copies


def plain_groups(rows):
    norm = [re.sub(rb"[\x20\x09-\x0d]+", b" ", (t or "").encode()) for _, t in rows]
    out = []
    for (i, _), n in zip(rows, norm, strict=True):
        same = [j for (j, _), m in zip(rows, norm, strict=True) if m == n]
        out.append((i, min(same), len(same), hashlib.sha256(n).hexdigest()))
    return sorted(out)


def test_exact_groups_equal_brute_force(spark):
    rng = random.Random(1)
    long = " ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) + str(rng.randrange(999)) for _ in range(20000))
    rows = [(9, "a  b"), (3, "a\tb"), (4, "a b "), (5, None), (6, ""), (7, " "), (8, "\n\n"), (10, long), (11, long.replace(" ", "\n")), (12, long[:-1]), (13, "x" + long), (14, "é é")]
    df = spark.createDataFrame([(i, t, "s", "clash") for i, t in rows], DOCS)
    got = exact_dedup.exact_groups(df)
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got.collect()) == plain_groups(rows)
    assert {r.doc_id for r in got.where("kept").collect()} == {i for i, k, _, _ in plain_groups(rows) if i == k}
    kept = exact_dedup.drop_exact_copies(df)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {3, 4, 5, 7, 10, 12, 13, 14}
    twice = spark.createDataFrame([(1, "t", "s", "x")] * 3 + [(None, "t", "s", "x")], DOCS)
    assert exact_dedup.exact_groups(twice).where("kept").count() == 1
    assert exact_dedup.exact_groups(df.limit(0)).count() == 0


def test_unverified_prints_are_told_apart_by_digest(spark):
    rows = spark.createDataFrame([(1, 1, "x", [5, 6], [b"a", b"b"]), (2, 2, "y", [5, 6], [b"c", b"b"]), (3, 3, "z", [5, 6], [b"a", b"b"])], "__row long, __id long, text_sha256 string, __prints array<long>, __digests array<binary>")
    got = {r.__getitem__("__id"): r.__getitem__("__recipe") for r in exact_dedup.recipes(rows).collect()}
    assert got[1] == got[3] != got[2]


def test_chunks_move_with_their_content():
    rng = random.Random(2)
    body = bytes(rng.randrange(97, 123) for _ in range(60000))
    one, two = set(exact_dedup.chunk(body)[0]), set(exact_dedup.chunk(b"some words in front " + body)[0])
    assert len(one & two) >= len(one) - 3
    ends = exact_dedup.cuts(body)
    assert ends[-1] == len(body) and all(b - a <= exact_dedup.MOST for a, b in zip([0, *ends], ends, strict=False))


# --- secrets


def test_secret_scan(spark):
    seen = Observation()
    assert spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).count() == 3 and seen.get["n"] == 3  # a session that has observed something
    token = "9f" * 20
    rows = [(i, f"some text {'token = ' if i % 2 else 'number '}\"{hashlib.sha1(str(i).encode()).hexdigest() if i % 2 else str(10**15 + i)}\" and more", "src/a", "k") for i in range(80)]
    df = spark.createDataFrame([*rows, (100, None, None, None), (101, "", None, None), (102, f"password={token} x password={token}", None, None)], DOCS)
    found = secrets.with_features(secrets.candidates(df), secrets.dictionary_of(df, least=2))
    model = secrets.fit(secrets.rule_labels(found))
    got = secrets.scan(found, model)
    assert {r.id for r in got.where("secret").collect()} == {i for i in range(80) if i % 2} | {102}
    assert [r.word_no for r in got.where("id = 102").orderBy("word_no").collect()] == [0, 2]
    none = secrets.with_features(secrets.candidates(df.limit(0)), None)
    assert secrets.scan(none, secrets.fit(secrets.rule_labels(none))).count() == 0


def test_the_dictionary_is_whole(spark):
    """Thousands of words, in documents with and without an id; the covered share is that of all of them, and repeated rows and other columns change nothing."""
    words = ["".join(chr(97 + k // 26**j % 26) for j in range(3)) + "word" for k in range(3000)]
    rows = [(None if i % 2 else i, " ".join(words), "src", "k") for i in range(5)] + [(10, f"x {words[7]}-{words[2900]}-12345678-unknownrun y", "a/b", "k")] * 2
    df = spark.createDataFrame(rows, DOCS).withColumn("f_covered", F.lit("clash")).withColumn("word", F.lit("clash"))
    held = secrets.dictionary_of(df)
    assert held.count() == 3000
    got = secrets.with_features(secrets.candidates(df), held)
    want = (len(words[7]) + len(words[2900])) / len(f"{words[7]}-{words[2900]}-12345678-unknownrun")
    assert [round(r.f_covered, 9) for r in got.collect()] == [round(want, 9)] * 2


def test_all_runs_of_a_word_are_candidates(spark):
    one, two = "wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY", "ghp_16C7e42F292c6912E7710c838347Ae178B4a"
    texts = [f'aws_secret_access_key="{one}"', f'{{"service_account_key":"{one}","n":1}}', f"https://internal.example.org?token={two}", f'a{{"token":"{one}","id":"{two}"}}', f"{one}|{one}", "no_digits_in_this_run:1"]
    df = spark.createDataFrame([(i, f"see {t} here", "s", "k") for i, t in enumerate(texts)], DOCS)
    rows = secrets.candidates(df)
    got = sorted((r.id, r.run_no, r.candidate) for r in rows.collect())
    assert got == [(0, 1, one), (1, 1, one), (2, 1, f"token={two}"), (3, 0, one), (3, 1, two), (4, 0, one), (4, 1, one)]
    marked = {(r.id, r.run_no): (r.label, r.f_named, r.f_assigned) for r in secrets.rule_labels(secrets.with_features(rows, None)).collect()}
    assert marked[0, 1][1:] == marked[3, 0][1:] == (1.0, 1.0)
    assert marked[2, 1] == (1.0, 1.0, 1.0) and marked[3, 1][:2] == (0.0, 0.0)  # the other secret's name is not its own
    minified = spark.createDataFrame([(1, ",".join(f'"k{i}":"{hashlib.sha1(str(i).encode()).hexdigest()}"' for i in range(3000)), "s", "k")], DOCS)
    many = secrets.candidates(minified)
    assert many.count() == 3000 and many.agg(F.max(F.length("word"))).first()[0] < 120


def test_dictionary_counts_all_texts(spark):
    words = [a + b for a in ("ban", "ter", "oli", "mak") for b in ("abcdefghij" * 2)[:10]]
    rows = [(i, f"common {words[i % 50] if i % 50 < 40 and i < 250 else ''}", "s", "k") for i in range(3000)]
    assert {r.word for r in secrets.dictionary_of(spark.createDataFrame(rows, DOCS)).collect()} == {"common", *words}


# --- preferences


def test_preferences(spark):
    schema = "conv_id long, turn int, role string, text string, pair_id string"
    rows = [(0, 0, "user", "hi", "c"), (0, 1, "assistant", "good", "c"), (0, 2, "user", "end", "c"), (1, 0, "user", "hi", "c"), (1, 1, "assistant", "bad", "c"), (2, 0, "user", "alone", "c"), (None, 0, "user", "x", "c"), (4, 0, None, None, "c"), (5, 0, "user", None, "c"), (4, 0, None, None, "c")]
    df = spark.createDataFrame(rows, schema)
    pair = F.floor(F.col("conv_id") / 2)
    got = preferences.preference_pairs(*(preferences.turns(df.where(F.pmod("conv_id", F.lit(2)) == k), pair) for k in (0, 1)))
    a, b, c = got.orderBy("pair_id").collect()
    assert (a.n_prompt, a.prompt, a.chosen, a.rejected) == (1, "<|user|>\nhi\n", "<|assistant|>\ngood\n<|user|>\nend\n", "<|assistant|>\nbad\n")
    assert (a.chosen_mask, a.rejected_mask) == ("1:19,0:13", "1:18")
    assert (b.chosen_id, b.rejected_id, b.prompt, b.chosen, b.rejected) == (2, None, "", "<|user|>\nalone\n", "")
    assert (c.n_prompt, c.prompt, c.chosen, c.rejected) == (1, "<|user|>\n\n", "", "")


def test_long_conversation_is_put_together_in_order(spark):
    rows = [(k, 0, i, "user", f"t{i}") for k in (0, 1) for i in range(300)] + [(0, 0, 300, "assistant", "yes"), (1, 0, 300, "assistant", "no")]
    df = spark.createDataFrame(rows, "side int, pair long, turn int, role string, text string")
    sides = [preferences.turns(df.where(f"side = {k}"), F.col("pair"), conv_col="side") for k in (0, 1)]
    got = preferences.preference_pairs(*sides, piece=16).first()
    assert got.n_prompt == 300 and got.prompt == "".join(f"<|user|>\nt{i}\n" for i in range(300)) and got.rejected == "<|assistant|>\nno\n"
