"""The registered queries of the training-data operators, each over its whole table, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewater.llm import decontamination, exact_dedup, fill_middle, html_text, line_dedup, mixing, near_dedup, preferences, quality, secrets, token_counts, toxicity, vector_codes
from tidewater.llm.common import table


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(table(spark, sf_dir, "pages"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings of all documents; the forest learns from findings that a rule labels, as no table holds labelled ones."""
    docs = table(spark, sf_dir, "documents")
    found = secrets.with_features(secrets.candidates(docs), secrets.dictionary_of(docs))
    model = secrets.fit(secrets.rule_labels(found))
    return secrets.scan(found, model).select(F.col("id").alias("doc_id"), "word_no", "run_no", F.sha2("candidate", 256).alias("candidate_sha256"), F.length("candidate").cast("long").alias("n_chars"), "probability", "secret")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), vocabulary())


def op4_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each conversation of even number is preferred to the next one."""
    rows = table(spark, sf_dir, "conversations")
    pair = F.floor(F.col("conv_id") / 2)
    return preferences.preference_pairs(*(preferences.turns(rows.where(F.pmod("conv_id", F.lit(2)) == k), pair) for k in (0, 1)))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, percent=80)


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grades are the ratings of quality, 0 and 1; a document is kept where the tail probability of 1 is such that 97 % of the good ones learnt from are kept."""
    docs = table(spark, sf_dir, "documents")
    ratings = learnable(table(spark, sf_dir, "labels")).select("doc_id", F.col("quality").alias("grade"))
    return quality.grade_documents(docs, quality.fit(docs, ratings, select_from=1), select_from=1)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents")).drop("__row")


def op9_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.transform("items", lambda i: i["item"]).alias("item_ids"), F.coalesce(F.array_max("items.words"), F.lit(0.0)).alias("words"), "contaminated")


def learnable(labels: DataFrame) -> DataFrame:
    """Labels that one may learn from: those of rows whose id's remainder is not 0."""
    return labels.where(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) != 0)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, learnable(table(spark, sf_dir, "labels")))
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    return toxicity.toxicity_scores(docs, model).select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = fill_middle.fill_in_middle(table(spark, sf_dir, "documents"))
    restored = fill_middle.restored(F.col("output"), F.col("form"))
    return cut.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(restored, 256).alias("restored_sha256"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = vector_codes.vector_codes(table(spark, sf_dir, "embeddings"))
    return codes.select("vec_id", "code", "error", "label_error", F.lit(vector_codes.codebooks_sha256(books)).alias("codebooks_sha256"))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lines = line_dedup.document_lines(docs)
    cleaned = line_dedup.dedup_lines(docs, lines, line_dedup.build(lines))
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def _codes_sql(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """Each round's full search and update as tables of their own; a distance and an index are one number."""
    steps = [
        f"""v as materialized (select vec_id, label, [floor(1024 * x::double) for x in embedding] as e from embeddings where embedding is not null and len([x for x in embedding if x is null or isnan(x) or isinf(x)]) = 0),
        p as materialized (select vec_id, label, part, e[part * (len(e) // {parts}) + 1:(part + 1) * (len(e) // {parts})] as x from v, range({parts}) t(part)),
        b0 as materialized (select part, entry, x as c from (select *, row_number() over (partition by part order by vec_id) - 1 as entry from p) where entry < {entries})"""
    ]
    for r in range(rounds + 1):
        steps.append(f"a{r} as materialized (select p.vec_id, p.label, p.part, p.x, min((list_dot_product(x, x) - 2 * list_dot_product(x, c) + list_dot_product(c, c)) * {entries} + entry)::bigint as best from p join b{r} using (part) group by all)")
        if r < rounds:
            steps.append(f"""m{r} as (select part, entry, list(mean order by pos) as c from (select part, best % {entries} as entry, pos, floor(sum(y) / count(*)) as mean from (select part, best, unnest(x) as y, generate_subscripts(x, 1) as pos from a{r}) group by all) group by all),
        b{r + 1} as materialized (select part, entry, coalesce(m{r}.c, b{r}.c) as c from b{r} left join m{r} using (part, entry))""")
    steps.append(f"""k as (select string_agg(array_to_string([y::bigint for y in c], ','), ',' order by part, entry) as books from b{rounds}),
        f as (select vec_id, any_value(label) as label, string_agg(printf('%02x', best % {entries}), '' order by part) as code, sum(best // {entries})::bigint as error from a{rounds} group by vec_id)
        select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, sha256(books) as codebooks_sha256 from f, k""")
    return "with " + ",\n        ".join(steps)


QUERIES = {
    "op1_html_text": op1_html_text,
    "op2_secret_scan": op2_secret_scan,
    "op3_token_counts": op3_token_counts,
    "op4_preference_pairs": op4_preference_pairs,
    "op5_near_dedup": op5_near_dedup,
    "op6_source_mix": op6_source_mix,
    "op7_quality": op7_quality,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_benchmark_leaks": op9_benchmark_leaks,
    "op10_toxicity": op10_toxicity,
    "op11_fill_middle": op11_fill_middle,
    "op12_vector_codes": op12_vector_codes,
    "op13_line_dedup": op13_line_dedup,
}

ORACLES = {
    "op4_preference_pairs": r"""
        with t as (select distinct conv_id // 2 as pair_id, conv_id % 2 as side, conv_id as conv, coalesce(turn, 4611686018427387904)::bigint as turn, coalesce(role, 'user') as role, coalesce(text, '') as text
            from conversations where conv_id is not null),
        m as (select pair_id, turn, string_agg(role || chr(1) || text, chr(2) order by role, text) filter (where side = 0) as a, string_agg(role || chr(1) || text, chr(2) order by role, text) filter (where side = 1) as b
            from t group by pair_id, turn),
        f as (select pair_id, min(turn) as first from m where a is distinct from b group by pair_id),
        p as (select t.*, first is null or turn < first as prompt, '<|' || role || '|>' || chr(10) || text || chr(10) as body from t left join f using (pair_id)),
        k as (select *, case when role = 'assistant' then '1:' else '0:' end || length(body) as mask from p)
        select pair_id, min(conv) filter (where side = 0) as chosen_id, min(conv) filter (where side = 1) as rejected_id,
            count(*) filter (where prompt and side = 0) as n_prompt,
            coalesce(string_agg(body, '' order by turn, role, text) filter (where prompt and side = 0), '') as prompt,
            coalesce(string_agg(body, '' order by turn, role, text) filter (where not prompt and side = 0), '') as chosen,
            coalesce(string_agg(body, '' order by turn, role, text) filter (where not prompt and side = 1), '') as rejected,
            coalesce(string_agg(mask, ',' order by turn, role, text) filter (where not prompt and side = 0), '') as chosen_mask,
            coalesce(string_agg(mask, ',' order by turn, role, text) filter (where not prompt and side = 1), '') as rejected_mask
        from k group by pair_id""",
    "op5_near_dedup": r"""
        with recursive w as (select doc_id, [x for x in string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') if x <> ''] as ws from documents),
        s as (select doc_id, unnest(case when len(ws) >= 4 then list_distinct([array_to_string(ws[i:i + 3], ' ') for i in range(1, len(ws) - 2)]) when len(ws) > 0 then [array_to_string(ws, ' ')] else [] end) as sh from w),
        n as (select doc_id, count(*) as n from s group by doc_id),
        p as (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.sh = b.sh and a.doc_id < b.doc_id group by all),
        l as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 80 * (x.n + y.n - c)),
        e as (select a as x, b as y from l union all select b, a from l),
        r(id, seen) as (select doc_id, doc_id from documents union select r.id, e.y from r join e on e.x = r.seen),
        m as (select id, min(seen) as component_id from r group by id)
        select d.doc_id, coalesce(n.n, 0) as n_shingles, m.component_id, d.doc_id = m.component_id as kept from documents d join m on m.id = d.doc_id left join n on n.doc_id = d.doc_id""",
    "op6_source_mix": r"""
        with recursive d as (
            select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size, coalesce(length(text), 0) as chars
            from documents),
        s as (select source, sum(size)::bigint as source_size from d group by source),
        w as (select *, [3.0, 1.0, 2.0][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int]::double as weight from s),
        c as (select *, 2.0::double * source_size as cap, 2.0::double * source_size / weight as ratio from w),
        k as (select *, sum(cap) over u as caps, sum(weight) over u as capped, sum(weight) over () as weights,
                1.5::double * sum(source_size) over () as budget, lead(ratio) over (order by ratio, source nulls last) as nxt, min(ratio) over () as least
            from c window u as (order by ratio, source nulls last rows between unbounded preceding and current row)),
        l as (select case when max(budget / weights) <= max(least) then max(budget / weights)
                else arg_min((budget - caps) / nullif(weights - capped, 0), caps) filter (where nxt is not null and (budget - caps) / nullif(weights - capped, 0) <= nxt) end as level from k),
        t as (select source, source_size, case when level is null then cap else least(cap, level * weight) end as target from k, l),
        e as (select *, case when source_size > 0 then floor(target / source_size) else 0 end as epochs from t),
        r0 as (select d.doc_id, d.source, d.size, e.source_size, e.target, e.epochs, e.target - e.epochs * e.source_size as "left", false as more,
                1 - pow((('0x' || substr(md5('17-' || d.doc_id), 1, 12))::bigint::double + 0.5) / 281474976710656.0, 1 / case when d.chars / greatest(d.size, 1)::double between 3 and 13 then 1.0 else 0.25 end) as key
            from d join e on d.source is not distinct from e.source),
        o1 as (select *, not more and size > 0 and size <= "left" as fits from r0),
        u1 as (select *, fits and sum(case when fits then size end) over (partition by source order by key, doc_id rows between unbounded preceding and current row) <= "left" as now from o1),
        r1 as (select * exclude (fits, now) replace (more or now as more, "left" - coalesce(sum(size) filter (where now) over (partition by source), 0) as "left") from u1),
        g(source, key, doc_id, "left") as (select source, -1.0::double, -1::bigint, max("left") from r1 group by source
            union all select source, key, doc_id, "left" from (select r.source, r.key, r.doc_id, g."left" - r.size as "left", row_number() over (partition by r.source order by r.key, r.doc_id) as k
                from g join r1 r on r.source is not distinct from g.source and not r.more and r.size > 0 and r.size <= g."left" and (r.key > g.key or r.key = g.key and r.doc_id > g.doc_id)) where k = 1)
        select doc_id, size, source_size, target, (size * (epochs + case when more or doc_id in (select doc_id from g) then 1 else 0 end))::bigint as taken from r1""",
    "op8_exact_dedup": r"""
        with n as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as t from documents)
        select doc_id, min(doc_id) over g as keep_id, count(*) over g as group_size, doc_id = min(doc_id) over g as kept, sha256(t) as text_sha256
        from n window g as (partition by t)""",
    "op11_fill_middle": r"""
        with u as (select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as u, sha256('42:' || doc_id) as h from documents),
        d as (select *, len(u)::bigint as n, ('0x' || h[1:8])::bigint as h1, ('0x' || h[9:16])::bigint as h2, ('0x' || h[17:24])::bigint as h3, ('0x' || h[25:32])::bigint as h4 from u),
        c as (select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
            case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 50 then 'plain' when h4 % 100 < 80 then 'spm' else 'psm' end as form from d),
        s as (select *, coalesce(array_to_string(u[1:a], ''), '') as p, coalesce(array_to_string(u[a + 1:b], ''), '') as m, coalesce(array_to_string(u[b + 1:], ''), '') as s from c)
        select doc_id, n, form, case when form <> 'plain' then length(p) end as prefix_chars, case when form <> 'plain' then length(m) end as middle_chars,
            sha256(case form when 'plain' then text when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256, sha256(text) as restored_sha256 from s""",
    "op12_vector_codes": _codes_sql(),
    "op13_line_dedup": r"""
        with d as (select doc_id, string_split(coalesce(text, ''), chr(10)) as ls from documents),
        l as (select doc_id, unnest(ls) as line, generate_subscripts(ls, 1) as k from d),
        n as (select *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from l),
        r as (select key, max(doc_id) as owner from n where length(key) >= 20 group by key having count(distinct doc_id) >= 3),
        g as (select n.*, owner is not null and owner <> doc_id as gone from n left join r using (key))
        select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped, sha256(coalesce(string_agg(line, chr(10) order by k) filter (where not gone), '')) as kept_sha256 from g group by doc_id""",
}
