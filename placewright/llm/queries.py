"""The registered queries of this subpackage, each over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import conversation_trie, decontam, exact_dedup, html_text, jaccard, line_dedup, packing, pii, quality, sharding, simhash, spelling, token_count


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), with_ids=False)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_sanitisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.span_report(pii.sanitise(table(spark, sf_dir, "documents")))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "lang", *[found[f"_{c}"].alias(c) for c in ("symbols", "perplexity", "threshold", "kept")])


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"), size=4, num=85, den=100)


def op7_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(table(spark, sf_dir, "documents"))


def op9_label_propagation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents")).drop("link_key")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_boilerplate(table(spark, sf_dir, "documents")).select("doc_id", "source", "n_lines", "n_dropped", "text")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_mixture_packing, op2_decontamination, op3_sanitisation, op4_quality_classifier, op5_exact_dedup, op6_jaccard_join, op7_style_tree, op8_token_counts, op9_label_propagation, op10_line_dedup, op11_spelling_variants, op12_conversation_trie, op13_simhash)}

#: crc32 of ``bytes`` (a list of integers): a table's entry is the xor of the entries of its bits, so that eight do.
_CRC = "xor(list_reduce(list_prepend(4294967295::bigint, {bytes}), lambda c, b: xor(c >> 8, {bits})), 4294967295::bigint)"
_CRC_BITS = (0x77073096, 0xEE0E612C, 0x076DC419, 0x0EDB8832, 0x1DB71064, 0x3B6E20C8, 0x76DC4190, 0xEDB88320)


def crc32_sql(text: str) -> str:
    """SQL for the crc32 of a string of code points up to U+00FF in UTF-8."""
    bits = "0::bigint"
    for k, v in enumerate(_CRC_BITS):
        bits = f"xor({bits}, ((xor(c, b) >> {k}) & 1) * {v})"
    code = "flatten(list_transform(string_split({t}, ''), lambda x: case when unicode(x) < 128 then [unicode(x)::bigint] else [192 + (unicode(x) >> 6)::bigint, 128 + (unicode(x) & 63)::bigint] end))"
    return _CRC.format(bytes=code.format(t=text), bits=bits)


ORACLES = {
    "op5_exact_dedup": """
        with d as (select doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) as h from documents)
        select doc_id, max(doc_id) over (partition by h) as keep_id, count(*) over (partition by h) as group_size,
               doc_id is not distinct from max(doc_id) over (partition by h) as kept, h as text_sha256
        from d""",
    "op10_line_dedup": """
        with d as (select row_number() over () as r, doc_id, source, text, string_split(text, chr(10)) as lines from documents),
        l as (select r, source, generate_subscripts(lines, 1) as i, unnest(lines) as line from d),
        hosts as (select source, count(*) as host_pages from d group by source),
        common as (select source, trim(line) as line, count(distinct r) as pages from l where trim(line) <> '' group by all),
        b as (select c.source, c.line from common c join hosts h on c.source is not distinct from h.source
              where c.pages >= 2 and c.pages > 0.1e0 * h.host_pages),
        k as (select l.r, count(*) as n_lines, count(b.line) as n_dropped,
                     coalesce(string_agg(l.line, chr(10) order by l.i) filter (where b.line is null), '') as text
              from l left join b on l.source is not distinct from b.source and trim(l.line) = b.line group by l.r)
        select d.doc_id, d.source, coalesce(k.n_lines, 0) as n_lines, coalesce(k.n_dropped, 0) as n_dropped,
               case when d.text is not null then k.text end as text
        from d left join k on k.r = d.r""",
    "op11_spelling_variants": f"""
        with recursive runs as (select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]{{5,}}')) as r from documents),
        counted as (select coalesce(doc_id::varchar, '') || ':' || r as k, r, count(*) as n from runs group by all),
        hashed as (select r, n, {crc32_sql('k')} as h from counted),
        made as (select case when h % 97 = 0 then substr(r, 1, (h % length(r))::int) || substr(r, (h % length(r))::int + 2) else r end as word, n from hashed),
        words as (select word, sum(n)::bigint as n from made where length(word) >= 5 group by 1 having sum(n) >= 3),
        cut as (select word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) as rest from (select word, n, unnest(range(1, length(word) + 1)) as i from words)),
        near as (select x.word as a, x.n as a_n, y.word as b, y.n as b_n from cut x join cut y on x.rest = y.rest and x.i = y.i and x.word <> y.word
                 union select x.word, x.n, w.word, w.n from cut x join words w on x.rest = w.word
                 union select w.word, w.n, x.word, x.n from cut x join words w on x.rest = w.word),
        best as (select a, count(*) as n_near, (list(b order by b_n desc, b))[1] as b, max(b_n) as b_n from near group by a),
        formed as (select word, n, case when b_n >= 2 * n then b end as form, coalesce(n_near, 0) as n_near, case when b_n >= 2 * n then b_n end as form_n from words left join best on a = word),
        walk as (select word, word as here, 0 as steps from formed union all select walk.word, f.form, steps + 1 from walk join formed f on f.word = walk.here where f.form is not null)
        select f.word, f.form, w.root, f.n, f.n_near, f.form_n from formed f join (select word, arg_max(here, steps) as root from walk group by word) w using (word)""",
    "op12_conversation_trie": f"""
        with turns as (select conv_id, coalesce(role, '') as role, coalesce(text, '') as text, row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), sha256(coalesce(text, ''))) as pos
                       from conversations where conv_id is not null),
        ids as (select distinct conv_id, {crc32_sql('conv_id::varchar')} % 4 as h from turns),
        again as (select t.* from turns t join ids using (conv_id) where conv_id % 20 = 0 or pos > h
                  union all select i.conv_id, t.role, t.text, t.pos from ids i join turns t on t.conv_id = i.conv_id - i.conv_id % 20 and t.pos <= i.h where i.conv_id % 20 <> 0),
        whole as (select conv_id, coalesce(list({{'role': role, 'text': text}} order by pos) filter (where pos is not null), []) as s from ids left join again using (conv_id) group by conv_id),
        heads as (select conv_id, s, unnest(range(0, len(s) + 1)) as depth from whole),
        members as (select conv_id, depth, s[1:depth] as path, len(s) = depth as ends from heads),
        nodes as (select path, depth, min(conv_id) as conv_id, count(*) as n_convs, sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where ends), '')) as ends_sha256 from members group by path, depth),
        kin as (select n.*, p.conv_id as parent_conv_id, (n.n_convs - 1) * len(regexp_extract_all(case when n.depth > 0 then n.path[n.depth].text else '' end, '[^\\x20\\x09-\\x0D]+')) as saved
                from nodes n left join nodes p on n.depth > 0 and p.depth = n.depth - 1 and p.path = n.path[1:n.depth - 1]),
        kids as (select path[1:depth - 1] as path, depth - 1 as depth, count(*) as n_children from nodes where depth > 0 group by all),
        below as (select u.path, u.depth, unnest(range(0, u.depth + 1)) as d, saved, k.path is null as leaf from kin u left join kids k on k.path = u.path and k.depth = u.depth),
        sums as (select path[1:d] as path, d as depth, sum(saved)::bigint as saved_tokens, count(*) filter (where leaf) as n_leaves from below group by all)
        select conv_id, n.depth, parent_conv_id, n_convs, coalesce(n_children, 0) as n_children, n_leaves, saved_tokens, ends_sha256
        from kin n join sums s on s.path = n.path and s.depth = n.depth left join kids k on k.path = n.path and k.depth = n.depth""",
}
