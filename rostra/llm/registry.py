"""The registered queries of this subpackage and the SQL that checks them."""

from rostra.llm import decontaminate, infill, interpolation, jaccard, licences, merkle, pieces, quality, secrets, simhash, tokenfiles, toxicity, warc

QUERIES = {
    "op1_deleted_interpolation": interpolation.op1_deleted_interpolation,
    "op2_quality_rules": quality.op2_quality_rules,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_benchmark_decontamination": decontaminate.op4_benchmark_decontamination,
    "op5_secret_scans": secrets.op5_secret_scans,
    "op6_warc_archives": warc.op6_warc_archives,
    "op7_licence_scans": licences.op7_licence_scans,
    "op8_sentencepiece": pieces.op8_sentencepiece,
    "op9_simhash_dedup": simhash.op9_simhash_dedup,
    "op10_token_files": tokenfiles.op10_token_files,
    "op11_merkle_manifest": merkle.op11_merkle_manifest,
    "op12_fill_in_middle": infill.op12_fill_in_middle,
    "op13_jaccard_join": jaccard.op13_jaccard_join,
}

_PLAIN = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[0-9a-z\\x{80}-\\x{10FFFF}]+')"
)

# The checksum of a number's digits, bit by bit: DuckDB has no crc32.
_CRC = (
    "xor(list_reduce(list_prepend(cast(4294967295 as bigint), list_transform(string_split(cast(doc_id as varchar), ''), "
    "lambda c: cast(ascii(c) as bigint))), lambda a, c: list_reduce(list_prepend(xor(a, c), cast([0, 0, 0, 0, 0, 0, 0, 0] as bigint[])), "
    "lambda x, y: xor(x >> 1, (x & 1) * 3988292384))), 4294967295)"
)


def _field(value: str) -> str:
    return f"case when {value} is null then '-' else strlen(cast({value} as varchar)) || ':' || cast({value} as varchar) end"


# Learned scores, hashes that SQL lacks and tokenizers are held against plain Python in the tests.
ORACLE: dict[str, str] = {
    "op4_benchmark_decontamination": f"""
        with docs as (select doc_id, {_PLAIN} as w from documents),
        items as (select cast(item_id as varchar) as item, {_PLAIN} as w from benchmark),
        wanted as (
          select item, least(len(w), 10) as n,
                 unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda i: array_to_string(w[i:i + 9], ' '))) as gram
          from items where len(w) > 0),
        sizes as (select distinct n from wanted),
        grams as (
          select doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') as gram
          from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from docs, sizes)),
        hits as (select doc_id, i, n, item from grams join wanted using (n, gram)),
        words as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + n)) as p from hits) group by doc_id),
        found as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as listed
                  from (select distinct doc_id, item from hits) group by doc_id)
        select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
               sha256(coalesce(listed, '')) as items_sha256, n_hit is not null as contaminated
        from docs left join words using (doc_id) left join found using (doc_id)""",
    "op6_warc_archives": """
        with p as (select page_id, coalesce(html, '') as t from pages),
        g as (select t, max(page_id) as first, sha1(t) as h from p group by t)
        select page_id, cast(strlen(p.t) as bigint) as payload_bytes,
               array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                 cast(1 + ((cast('0x' || substr(h, cast(1 + 5 * (k // 4) as int), 5) as bigint) >> (15 - 5 * (k % 4))) & 31) as int), 1)), '')
                 as payload_digest,
               case when page_id = first then 'response' else 'revisit' end as record_type,
               case when page_id <> first then first end as refers_to
        from p join g on p.t = g.t""",
    "op11_merkle_manifest": f"""
        with recursive d as (
          select doc_id, lang, n_chars, {_field('doc_id')} || {_field('source')} || {_field('lang')} as head, {_field('text')} as tail,
                 {_CRC} % 7 = 0 and n_chars is not null as chosen from documents),
        l as (select doc_id, lang, sha256(head || {_field('n_chars')} || tail) as leaf, row_number() over (partition by lang order by doc_id) - 1 as i,
                     case when chosen then sha256(head || {_field('n_chars + 1')} || tail) end as false_leaf from d),
        own as (
          select lang, 0 as k, i, leaf as h from l
          union all
          select lang, k, i // 2, sha256(string_agg(h, '' order by i)) from
            (select lang, k + 1 as k, i, h, count(*) over (partition by lang) as n from own) where n > 1 group by lang, k, i // 2),
        subs as (select lang, arg_max(h, k) as subroot, max(k) as deep from own group by lang),
        top as (
          select 0 as k, row_number() over (order by lang nulls first) - 1 as i, subroot as h from subs
          union all
          select k, i // 2, sha256(string_agg(h, '' order by i)) from
            (select k + 1 as k, i, h, count(*) over () as n from top) where n > 1 group by k, i // 2),
        roots as (select arg_max(h, k) as root, max(k) as high from top),
        place as (select lang, subroot, deep, row_number() over (order by lang nulls first) - 1 as p from subs),
        walk as (
          select doc_id, i, lang, leaf, false_leaf, subroot, root, p, unnest(range(0, deep + high)) as k, deep
          from l join place using (lang), roots
          union all
          select doc_id, i, l.lang, leaf, false_leaf, subroot, root, p, unnest(range(0, deep + high)) as k, deep
          from l join place on l.lang is null and place.lang is null, roots),
        steps as (
          select w.*, case when w.k < w.deep then o.h else t.h end as sib,
                 case when w.k < w.deep then o.i < (w.i >> w.k) else t.i < (w.p >> (w.k - w.deep)) end as sib_first
          from walk w
          left join own o on w.k < w.deep and o.lang is not distinct from w.lang and o.k = w.k and o.i = xor(w.i >> w.k, 1)
          left join top t on w.k >= w.deep and t.k = w.k - w.deep and t.i = xor(w.p >> (w.k - w.deep), 1)),
        lists as (
          select doc_id, i, lang, any_value(leaf) as leaf, any_value(false_leaf) as false_leaf,
                 list(case when sib is null then 'N' when sib_first then 'L' || sib else 'R' || sib end order by k) as s
          from steps group by doc_id, i, lang),
        whole as (
          select l.doc_id, l.leaf, subroot, root, coalesce(l.false_leaf, l.leaf) as start, coalesce(s, []) as s
          from l join place on l.lang is not distinct from place.lang
          left join lists on lists.i = l.i and lists.lang is not distinct from l.lang, roots),
        folds as (
          select *, list_reduce(list_prepend(start, s), lambda a, b: sha256(case b[1] when 'L' then b[2:] || a when 'R' then a || b[2:] else a end))
                 as folded_root from whole)
        select doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(s, lambda x: x[2:]), '')) as proof_sha256, folded_root,
               folded_root = root as verified from folds""",
    "op12_fill_in_middle": """
        with h as (select doc_id, coalesce(text, '') as t, sha256('1:' || cast(doc_id as varchar)) as d from documents),
        u as (
          select doc_id, t, length(t) as n, cast('0x' || d[1:8] as bigint) as h1, cast('0x' || d[9:16] as bigint) as h2,
                 cast('0x' || d[17:24] as bigint) as h3, cast('0x' || d[25:32] as bigint) as h4 from h),
        cuts as (
          select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
                 case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 90 then 'plain'
                      when h4 % 100 < 20 then 'spm' else 'psm' end as form from u),
        parts as (select *, substr(t, 1, a) as p, substr(t, a + 1, b - a) as m, substr(t, b + 1) as s from cuts)
        select doc_id, n, form, case when form <> 'plain' then a end as prefix_chars,
               case when form <> 'plain' then b - a end as middle_chars,
               sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
                      else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
               sha256(t) as restored_sha256 from parts""",
}
