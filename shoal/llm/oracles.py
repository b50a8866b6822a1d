"""DuckDB SQL for the queries of this subpackage that SQL can express.

The others learn models (op1, op2), apply a vocabulary (op5, op6), or work with places of matches and entropy (op7, op8); their tests
compare them with plain versions.
"""

from __future__ import annotations

from shoal.llm import quality_rules as rules


def contamination(window: int = 13) -> str:
    words = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""
    with items as (select cast(item_id as varchar) item, {words} w from benchmark),
    win as (select item, least({window}, len(w)) n, array_to_string(w[i : i + least({window}, len(w)) - 1], ' ') k, i j
            from (select item, w, unnest(range(1, greatest(1, len(w) - {window} + 1) + 1)) i from items where len(w) > 0)),
    docs as (select doc_id, {words} w from documents),
    sizes as (select distinct n from win),
    spot as (select doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') k
           from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) i from docs, sizes where len(w) >= n)),
    hit as (select distinct doc_id, i, spot.n, item, j from spot join win on spot.n = win.n and spot.k = win.k),
    runs as (select doc_id, min(i) a, count(*) + n - 1 len from (select *, i - row_number() over (partition by doc_id, item, n, i - j order by i) g from hit) group by doc_id, item, n, i - j, g),
    long as (select doc_id, max(len) longest, arg_max(a, len * 1000000000 - a) - 1 a from runs group by doc_id),
    per_item as (select doc_id, count(distinct item) n_items, sha256(array_to_string(list_sort(list(distinct item)), ',')) s from hit group by doc_id),
    places as (select doc_id, count(distinct p) n_hit from (select doc_id, unnest(range(i, i + n)) p from hit) group by doc_id)
    select doc_id, cast(len(w) as bigint) n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items, coalesce(s, sha256('')) items_sha256, cast(coalesce(longest, 0) as bigint) longest_match, cast(coalesce(a, -1) as bigint) longest_at,
           coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) contaminated
    from docs left join per_item using (doc_id) left join places using (doc_id) left join long using (doc_id)"""


WARC = """
    with p as (select page_id, encode(coalesce(html, '')) b from pages),
    d as (select page_id, octet_length(b) n, sha1(b) h, min(page_id) over (partition by b) f from p),
    five as (select *, list_transform(range(0, 8), lambda g: list_reduce(list_transform(range(1, 6), lambda j: instr('0123456789abcdef', substr(h, cast(g * 5 + j as integer), 1)) - 1), lambda a, x: a * 16 + x)) v from d)
    select page_id, cast(n as bigint) payload_bytes,
           array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast(1 + (v[i // 4 + 1] >> (15 - 5 * (i % 4))) % 32 as integer), 1)), '') payload_digest,
           case when f = page_id then 'response' else 'revisit' end record_type, case when f <> page_id then f end refers_to
    from five"""


def quality() -> str:
    space = r"[^\x20\x09-\x0D]"
    bands = " + ".join(f"cast(n_words >= {b} as integer)" for b in rules.BANDS)
    ratio = lambda a, b: f"coalesce(cast({a} as double) / nullif(cast({b} as double), 0), 0)"
    measure = {
        "symbols_per_word": ratio("n_symbols", "n_words"),
        "duplicate_lines": ratio("n_dup_lines", "n_lines"),
        "repeated_words": ratio("n_repeat_words", "n_words"),
        "word_length": ratio("word_chars", "n_words"),
        "exclamations": ratio("n_exclamations", "n_words"),
        "upper_case": ratio("n_upper", "word_chars"),
    }
    order = sorted((i / len(cs), list(rules.GRID).index(r), r, c) for r, cs in rules.GRID.items() for i, c in enumerate(cs))
    grid = ", ".join(f"('{r}', {n}, cast({c} as double))" for n, (_, _, r, c) in enumerate(order, 1))
    rows = " union all ".join(f"select *, '{r}' rule, {m} x from m" for r, m in measure.items())
    level = rules.DELTA / (len(rules.BANDS) + 1)
    p = rules.RISK
    tail = f"case when k >= n * {p} then 1.0 else list_sum(list_transform(range(0, k + 1), lambda j: exp(lgamma(n + 1.0) - lgamma(j + 1.0) - lgamma(n - j + 1.0) + j * ln({p}) + (n - j) * ln(1 - {p})))) end"
    return f"""
    with w as (select doc_id, coalesce(text, '') t, regexp_extract_all(coalesce(text, ''), '{space}+') w,
                      list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '{space}')) l from documents),
    g as (select doc_id, i, array_to_string(w[i : i + 2], chr(0)) k from (select doc_id, w, unnest(range(1, len(w) - 1)) i from w where len(w) >= 3)),
    twice as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, k) c from g) where c > 1),
    rep as (select doc_id, count(distinct p) n from (select doc_id, unnest(range(i, i + 3)) p from twice) group by doc_id),
    m as (select doc_id, cast(len(w) as bigint) n_words, cast(length(array_to_string(w, '')) as bigint) word_chars, cast(len(regexp_extract_all(t, '[#*$%&|<>]')) as bigint) n_symbols,
                 cast(len(l) - len(list_distinct(l)) as bigint) n_dup_lines, coalesce(n, 0) n_repeat_words, len(l) n_lines, len(regexp_extract_all(t, '!')) n_exclamations, len(regexp_extract_all(t, '[A-Z]')) n_upper,
                 len(w) < 50 or 100 * coalesce(n, 0) > 50 * len(w) base_failed
          from w left join rep using (doc_id)),
    x as ({rows}),
    grid(rule, step, c) as (values {grid}),
    lab as (select doc_id, max(quality) > 0 good from labels where doc_id is not null and quality is not null group by doc_id),
    own as (select doc_id, rule, min(step) step from x join grid using (rule) where x >= c group by all),
    held as (select doc_id, {bands} s, good from m join lab using (doc_id) where not base_failed),
    firsts as (select doc_id, min(step) step from own group by doc_id),
    sums as (select s, step, count(*) filter (good) g, count(*) filter (not good) b from held left join firsts using (doc_id) group by all),
    steps as (select s, step, cast(sum(g) over (partition by s) as bigint) n, cast(sum(g) over w as bigint) k, sum(b) over w b from sums window w as (partition by s order by step nulls last)),
    tails as (select *, {tail} tail from steps where step is not null),
    path as (select *, min(cast(tail <= {level!r} as integer)) over (partition by s order by step) ok from tails),
    best as (select s, arg_max(step, (b - {rules.PRICE} * k) * 1000 - step) step from path where ok = 1 and b - {rules.PRICE} * k > 0 group by s),
    used as (select s, rule from held join own using (doc_id) join best using (s) where own.step <= best.step group by all),
    bad as (select distinct m.doc_id from m join own using (doc_id) join best on {bands} = best.s join used on used.s = best.s and used.rule = own.rule where own.step <= best.step)
    select m.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and bad.doc_id is null kept
    from m left join bad using (doc_id)"""


SIMILARITY = r"""
    with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') w from documents),
    s as (select distinct doc_id, array_to_string(w[i : i + 4], ' ') g from (select doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) i from w where len(w) > 0)),
    n as (select doc_id, count(*) n from s group by doc_id),
    shared as (select a.doc_id a, b.doc_id b, count(*) c from s a join s b on a.g = b.g and a.doc_id <> b.doc_id group by all),
    link as (select a, b from shared join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 75 * (x.n + y.n - c)),
    reach as (select a, b from link union select reach.a, link.b from reach join link on reach.b = link.a),
    low as (select a, min(b) m from reach group by a)
    select w.doc_id, coalesce(n.n, 0) n_shingles, least(w.doc_id, coalesce(m, w.doc_id)) component_id
    from w left join n using (doc_id) left join low on low.a = w.doc_id"""


def oracle_sql() -> dict[str, str]:
    return {"op3_decontamination": contamination(), "op4_warc": WARC, "op9_quality_rules": quality(), "op10_similarity_join": SIMILARITY}
