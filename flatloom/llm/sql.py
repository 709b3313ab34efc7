"""SQL for the queries that SQL can express, over the same tables."""

from __future__ import annotations

from flatloom.llm.url_filter import RULES, UrlRule

_SPACE = r"[\x20\x09-\x0D]"
_WORD = r"[^\x20\x09-\x0D]+"

_WORDS = f"""
    d as (select doc_id, coalesce(text, '') t, regexp_extract_all(coalesce(text, ''), '{_WORD}') ws from documents),
    words as (select doc_id, unnest(ws) word, generate_subscripts(ws, 1) i from d)"""

QUALITY = f"""
    with {_WORDS},
    windows as (
        select doc_id, i, word, lead(word, 1) over o w1, lead(word, 2) over o w2
        from words window o as (partition by doc_id order by i)),
    twice as (
        select doc_id, i from (
            select *, count(*) over (partition by doc_id, word, w1, w2) c from windows where w2 is not null)
        where c > 1),
    covered as (
        select doc_id, count(distinct i + k) n from twice cross join (values (0), (1), (2)) v(k) group by 1),
    lines as (
        select doc_id, count(*) - count(distinct line) n
        from (select doc_id, unnest(string_split(t, chr(10))) line from d)
        where regexp_matches(line, '{_WORD}') group by 1),
    m as (
        select d.doc_id, len(ws) n_words, length(regexp_replace(t, '{_SPACE}', '', 'g')) word_chars,
            length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) n_symbols,
            coalesce(lines.n, 0) n_dup_lines, coalesce(covered.n, 0) n_repeat_words
        from d left join lines using (doc_id) left join covered using (doc_id)),
    b as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words base_failed from m)
    select *, not base_failed and word_chars between 2 * n_words and 20 * n_words
        and 10 * n_symbols <= 3 * n_words and 10 * n_dup_lines <= n_words kept
    from b"""

# The windows that repeat an earlier one are merged into spans; what lies between them stays.
REPEATED_WORDS = f"""
    with {_WORDS},
    windows as (
        select doc_id, i, string_agg(word, ' ') over o w, count(*) over o n
        from words window o as (partition by doc_id order by i rows between current row and 19 following)),
    later as (
        select doc_id, i from (
            select doc_id, i, row_number() over (partition by w order by doc_id, i) r from windows where n = 20)
        where r > 1),
    near as (
        select words.doc_id, words.i, word,
            max(later.i) over (partition by words.doc_id order by words.i
                rows between unbounded preceding and current row) last
        from words left join later on later.doc_id = words.doc_id and later.i = words.i),
    marked as (select doc_id, i, word, last is not null and i < last + 20 gone from near)
    select d.doc_id, len(ws) n_words, coalesce(sum(gone::int), 0)::bigint n_removed,
        sha256(coalesce(string_agg(word, ' ' order by i) filter (not gone), '')) kept_sha256
    from d left join marked using (doc_id) group by d.doc_id, ws"""

REPEATED_BYTES = """
    with d as (select doc_id, hex(coalesce(text, '')) h, strlen(coalesce(text, '')) n from documents),
    windows as (
        select doc_id, i, substr(h, 2 * i + 1, 200) w
        from (select doc_id, h, unnest(range(n - 99)) i from d where n >= 100)),
    later as (
        select doc_id, i from (select doc_id, i, row_number() over (partition by w order by doc_id, i) r from windows)
        where r > 1),
    starts as (
        select doc_id, i, coalesce(i > lag(i) over (partition by doc_id order by i) + 100, true) new from later),
    numbered as (select doc_id, i, sum(new::int) over (partition by doc_id order by i) span from starts),
    spans as (select doc_id, span, min(i) a, max(i) + 100 b from numbered group by 1, 2),
    edges as (
        select d.doc_id, h, n, span, a, b, coalesce(lag(b) over o, 0) before, lead(a) over o is null is_last
        from d left join spans using (doc_id) window o as (partition by d.doc_id order by span))
    select doc_id, n n_bytes, coalesce(sum(b - a), 0)::bigint n_removed, count(span) n_spans,
        sha256(from_hex(coalesce(string_agg(
            case when span is null then h
                else substr(h, 2 * before + 1, 2 * (a - before)) || case when is_last then substr(h, 2 * b + 1) else '' end
            end, '' order by span), ''))) kept_sha256
    from edges group by doc_id, n"""

EXACT = f"""
    with d as (
        select doc_id, length(coalesce(text, '')) chars, regexp_replace(coalesce(text, ''), '{_SPACE}', '', 'g') t
        from documents),
    g as (
        select doc_id, t, first_value(doc_id) over (partition by t order by chars desc, doc_id) keep_id,
            count(*) over (partition by t) group_size
        from d)
    select doc_id, keep_id, group_size, doc_id = keep_id kept, sha256(t) text_sha256 from g"""


def _rule_case(host: str, path: str, rules: tuple[UrlRule, ...], result: str) -> str:
    best = sorted(rules, key=lambda r: (len(r.name), r.verdict == "allow"), reverse=True)
    cases = [
        f"when ({host} = '{r.host}' or {host} like '%.{r.host}') and starts_with({path}, '{r.path}') "
        f"then '{r.name if result == 'name' else r.verdict}'"
        for r in best
    ]
    return f"case {' '.join(cases)} end"


_HOST = r"translate(regexp_extract(coalesce({0}, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PATH = r"regexp_extract(coalesce({0}, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1)"
_REST = r"regexp_extract(coalesce({0}, ''), '(?s)^.*?://[^/?#]*([^#]*)', 1)"

URLS = rf"""
    with recursive p as (
        select page_id, url, html, {_HOST.format("url")} host, {_PATH.format("url")} path,
            case when contains(url, '://') then {_HOST.format("url")} || {_REST.format("url")} end address
        from pages),
    tags as (
        select url, regexp_extract(regexp_extract(html,
            '(?is)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>'), '(?is)\bhref\s*=\s*["'']?\s*([^"''\s>]+)', 1) t from p
        union all select url, regexp_extract(regexp_extract(html,
            '(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>'), '(?is)\burl\s*=\s*["'']?\s*([^"''\s>]+)', 1) from p),
    links as (
        select url, case when contains(t, '://') then t
            when starts_with(t, '//') then regexp_extract(url, '(?s)^(.*?)://', 1) || ':' || t
            when starts_with(t, '/') then regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1) || t
            else rtrim(regexp_extract(url, '(?s)^(.*?://[^/?#]*(?:[^?#]*/)?)', 1), '/') || '/' || t end target
        from tags where t <> '' and contains(url, '://')),
    ends as (
        select {_HOST.format("u")} host, {_PATH.format("u")} path, {_HOST.format("u")} || {_REST.format("u")} node
        from (select url u from links union select target from links)),
    edges as (
        select {_HOST.format("url")} || {_REST.format("url")} a, {_HOST.format("target")} || {_REST.format("target")} b from links),
    both_ways as (select a, b from edges union select b, a from edges),
    reach(node, other) as (
        select node, node from ends union select r.node, e.b from reach r join both_ways e on e.a = r.other),
    inherited as (
        select r.node, case when bool_or({_rule_case("e.host", "e.path", RULES, "verdict")} = 'allow') then 'allow' else 'block' end v
        from reach r join ends e on e.node = r.other
        where {_rule_case("e.host", "e.path", RULES, "verdict")} is not null group by 1)
    select page_id, host, path, {_rule_case("host", "path", RULES, "name")} rule,
        coalesce({_rule_case("host", "path", RULES, "verdict")}, v, 'allow') verdict
    from p left join inherited on inherited.node = p.address"""


def _centroids(rounds: int, k: int, dimensions: int, scale: int) -> str:
    """Each round as a table of its own: assigned, then the floors of the means."""
    steps = [
        f"""
    kept as materialized (
        select vec_id, list_transform(embedding, lambda x: floor({scale} * x::double)::bigint) v from embeddings
        where len(embedding) = {dimensions} and len(list_filter(embedding, lambda x: isfinite(x))) = {dimensions}),
    values_of as materialized (select vec_id, unnest(v) x, generate_subscripts(v, 1) d from kept),
    c0 as materialized (
        select row_number() over (order by sha256('2:' || vec_id), v) - 1 cluster, v
        from kept order by sha256('2:' || vec_id), v limit {k})"""
    ]
    for i in range(rounds + 1):
        steps.append(f"""
    a{i} as materialized (
        select vec_id, cluster, s from (
            select vec_id, cluster, s, row_number() over (partition by vec_id order by s, cluster) r from (
                select kept.vec_id, c.cluster, list_sum(list_transform(
                    list_zip(kept.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::bigint s
                from kept cross join c{i} c))
        where r = 1)""")
        if i < rounds:
            steps.append(f"""
    m{i} as materialized (
        select cluster, list((t - ((t % n) + n) % n) // n order by d) v from (
            select cluster, d, sum(x)::bigint t, count(*) n from a{i} join values_of using (vec_id) group by 1, 2)
        group by 1),
    c{i + 1} as materialized (
        select c{i}.cluster, coalesce(m{i}.v, c{i}.v) v from c{i} left join m{i} using (cluster))""")
    return f"""
    with {",".join(steps)}
    select vec_id, cluster::int cluster, s distance, (sum(s) over (partition by cluster))::bigint cluster_inertia,
        (sum(s) over ())::bigint inertia, sha256(array_to_string(v, ',')) centroid_sha256
    from a{rounds} join c{rounds} using (cluster)"""


CENTROIDS = _centroids(rounds=5, k=40, dimensions=64, scale=256)

# The CRC-32 is computed bit by bit, for want of a function: a fold over the digits of the id.
_CRC = """xor(4294967295, list_reduce(
            list_prepend(4294967295, list_transform(string_split(conv_id::varchar, ''), lambda x: ascii(x)::bigint)),
            lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), list_transform(range(8), lambda i: 0::bigint)),
                lambda c, i: xor(c >> 1, 3988292384 * (c & 1)))))"""

PREFIXES = f"""
    with t as materialized (
        select conv_id, {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} x,
            row_number() over (partition by conv_id order by turn nulls first, role, text) - 1 pos
        from conversations),
    c as materialized (
        select conv_id, conv_id - conv_id % 20 base, list(x order by pos) own, ({_CRC} % 4)::bigint h from t group by conv_id),
    r as materialized (
        select c.conv_id, list_concat(coalesce(b.own[1:c.h], []), c.own[c.h + 1:]) path from c left join c b on b.conv_id = c.base),
    p as materialized (
        select conv_id, path[1:d] prefix, d depth, d = len(path) ended
        from (select conv_id, path, unnest(range(len(path) + 1)) d from r)),
    n as materialized (
        select prefix, depth, min(conv_id) conv_id, count(*) n_convs,
            coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (ended), '') ends,
            case when depth > 0 then len(regexp_extract_all(prefix[-1].text, '{_WORD}')) else 0 end words
        from p group by 1, 2),
    k as materialized (
        select n.prefix, n.depth, any_value(up.conv_id) parent_conv_id from n left join n up
            on up.depth = n.depth - 1 and up.prefix = n.prefix[1:n.depth - 1] group by 1, 2),
    s as materialized (
        select up.prefix, up.depth, count(*) filter (n.depth = up.depth + 1) n_children,
            sum((n.n_convs - 1) * n.words)::bigint saved_tokens,
            count(*) filter (not exists (select 1 from n x where x.depth = n.depth + 1 and x.prefix[1:n.depth] = n.prefix)) n_leaves
        from n up join n on n.depth >= up.depth and n.prefix[1:up.depth] = up.prefix group by 1, 2)
    select conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, sha256(ends) ends_sha256
    from n join k using (prefix, depth) join s using (prefix, depth)"""
