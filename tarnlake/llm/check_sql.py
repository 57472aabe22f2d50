"""Check SQL of the operators that SQL can express, for the whole tables."""

from __future__ import annotations

from tarnlake.llm.chat_format import INSTRUCTION
from tarnlake.llm.quality_rules import STOP_WORDS

_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_UPPER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'"
_LOWER = "'abcdefghijklmnopqrstuvwxyz'"


def _chat() -> str:
    quoted = "</s>[INST] ok [/INST]"
    pattern = "|".join(
        "".join(f"\\{c}" if c in "[]" else c for c in mark) for mark in INSTRUCTION.controls
    )
    escaped = (
        "length({0}) + length({0}) - length(replace({0}, chr(92), ''))"
        f" + 2 * len(regexp_extract_all({{0}}, '{pattern}'))"
    )
    marks = " ".join(
        f"WHEN '{name}' THEN {len(role.before) + len(role.after)}"
        for name, role in INSTRUCTION.roles.items()
    )
    other = f"{sum(map(len, INSTRUCTION.other))} + {escaped.format('role')}"
    order = "ORDER BY turn, role, text"
    return f"""
    WITH turns AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT -7, 0, 'user', '{quoted}' UNION ALL SELECT -7, 1, 'assistant', '{quoted}')
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' {order})) AS turns_sha256,
           cast(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(text, '' {order}) FILTER (role = 'assistant'), '')) AS loss_sha256,
           cast({len(INSTRUCTION.opening)} + sum({escaped.format('text')} + CASE role {marks} ELSE {other} END) AS BIGINT)
             AS formatted_chars
    FROM turns GROUP BY conv_id
    """


def _quality() -> str:
    stops = ", ".join(f"'{w}'" for w in STOP_WORDS)
    ratio = "CASE WHEN {1} > 0 THEN {0} / {1} ELSE 0 END"
    return rf"""
    WITH docs AS (
      SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS body, {_WORDS} AS w FROM documents),
    spots AS (SELECT r, i, array_to_string(w[i:i + 7], ' ') AS g FROM
      (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM docs WHERE len(w) >= 8) x),
    twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM spots) y WHERE c > 1),
    again AS (SELECT r, sum(least(8, coalesce(next - i, 8))) AS n FROM
      (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS next FROM twice) z GROUP BY r),
    counts AS (
      SELECT doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars,
             length(regexp_replace(body, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
             len(solid) - len(list_distinct(solid)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
             len(list_filter(w, lambda x: lower(x) IN ({stops}))) AS stops, len(solid) AS n_lines,
             len(list_filter(solid, lambda x: regexp_matches(x, '^ *[-*•]'))) AS bullets,
             len(list_filter(solid, lambda x: regexp_matches(x, '(\.\.\.|…) *$'))) AS dots
      FROM (SELECT *, list_filter(string_split(body, chr(10)), lambda x: trim(x, {_BLANKS}) <> '') AS solid FROM docs) d
      LEFT JOIN again USING (r)),
    based AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counts)
    SELECT doc_id, cast(n_words AS BIGINT) AS n_words, cast(word_chars AS BIGINT) AS word_chars,
           cast(n_symbols AS BIGINT) AS n_symbols, cast(n_dup_lines AS BIGINT) AS n_dup_lines,
           cast(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
           NOT base_failed AND {ratio.format('word_chars', 'n_words')} BETWEEN 2 AND 14
           AND {ratio.format('n_symbols', 'word_chars')} <= 0.1
           AND (n_words < 50 OR stops / n_words >= 0.02)
           AND {ratio.format('n_dup_lines', 'n_lines')} <= 0.5
           AND {ratio.format('bullets', 'n_lines')} <= 0.9
           AND {ratio.format('dots', 'n_lines')} <= 0.3 AS kept
    FROM based
    """


_JACCARD = f"""
    WITH RECURSIVE docs AS (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_UPPER}, {_LOWER}), '[^\\x20\\x09-\\x0D]+') AS w
      FROM documents),
    grams AS (
      SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM
        (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM docs WHERE len(w) > 0) x),
    sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY 1),
    common AS (
      SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id
      GROUP BY 1, 2),
    links AS (
      SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
      WHERE 100 * c >= 80 * (x.n + y.n - c)),
    both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
    reach AS (SELECT DISTINCT a AS origin, a AS node FROM both_ways UNION SELECT origin, b FROM reach JOIN both_ways ON node = a)
    SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(least(d.doc_id, m), d.doc_id) AS component_id
    FROM docs d LEFT JOIN sizes USING (doc_id)
    LEFT JOIN (SELECT origin AS doc_id, min(node) AS m FROM reach GROUP BY 1) r USING (doc_id)
"""

_MIX = f"""
    WITH sized AS (
      SELECT doc_id, source, len({_WORDS}) AS size, md5('mix:' || coalesce(cast(doc_id AS VARCHAR), '')) AS key FROM documents),
    sources AS (SELECT source, cast(sum(size) AS DOUBLE) AS s FROM sized GROUP BY 1),
    weighed AS (SELECT *, [1, 2, 3][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM sources),
    ranked AS (SELECT *, row_number() OVER (ORDER BY s / w, source NULLS LAST) AS k FROM weighed),
    filled AS (
      SELECT *, (sum(s) OVER () - coalesce(sum(3 * s) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / (sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
      FROM ranked),
    targets AS (
      SELECT source, s, coalesce(least(3 * s, w * (SELECT level FROM filled f WHERE level * w <= 3 * s ORDER BY k LIMIT 1)), 3 * s) AS target
      FROM filled),
    placed AS (
      SELECT d.*, s, target, coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
      FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
    cut AS (SELECT *, CASE WHEN s > 0 THEN floor(round(target) / s) ELSE 0 END AS whole FROM placed)
    SELECT doc_id, cast(size AS BIGINT) AS size, cast(s AS BIGINT) AS source_size, target,
           cast(size * (whole + CASE WHEN size > 0 AND 2 * start + size <= 2 * (round(target) - whole * s) THEN 1 ELSE 0 END) AS BIGINT) AS taken
    FROM cut
"""

_LINES = f"""
    WITH docs AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
    lines AS (
      SELECT r, doc_id, i, parts[i] AS line, translate(trim(parts[i], {_BLANKS}), {_UPPER}, {_LOWER}) AS key
      FROM (SELECT r, doc_id, parts, unnest(range(1, len(parts) + 1)) AS i FROM docs) x),
    common AS (SELECT key, max(doc_id) AS last FROM lines WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
    judged AS (SELECT l.*, last IS NOT NULL AND last <> doc_id AS gone FROM lines l LEFT JOIN common USING (key))
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
    FROM judged GROUP BY r, doc_id
"""

_PASSAGES = f"""
    WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
    spots AS (SELECT r, doc_id, w[i] AS word, i, CASE WHEN i + 49 <= len(w) THEN array_to_string(w[i:i + 49], ' ') END AS g
      FROM (SELECT r, doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM docs) x),
    firsts AS (SELECT *, g IS NOT NULL AND min(doc_id) OVER (PARTITION BY g) < doc_id AS repeated FROM spots),
    cover AS (SELECT *, max(CASE WHEN repeated THEN 1 ELSE 0 END) OVER
      (PARTITION BY r ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone FROM firsts),
    kept AS (SELECT r, count(*) FILTER (gone = 1) AS n, string_agg(word, ' ' ORDER BY i) FILTER (gone = 0) AS body FROM cover GROUP BY r)
    SELECT doc_id, cast(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(body, '')) AS kept_sha256
    FROM docs LEFT JOIN kept USING (r)
"""

_ARCHIVES = """
    WITH sized AS (SELECT page_id, coalesce(html, '') AS body, strlen(coalesce(html, '')) AS n FROM pages),
    firsts AS (SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY body) END AS last FROM sized)
    SELECT page_id, cast(n AS BIGINT) AS payload_bytes, sha1(body) AS payload_digest,
           CASE WHEN last IS NULL OR last IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN last IS DISTINCT FROM page_id THEN last END AS refers_to
    FROM firsts
"""



def _crc32(codes: str) -> str:
    """CRC-32 of a list of byte values, bit by bit."""
    bit = "lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    step = f"list_reduce(range(8), {bit}, xor(c, b))"
    return f"xor(list_reduce({codes}, lambda c, b: {step}, 4294967295), 4294967295)"


_DIGITS = "list_transform(string_split(cast(c AS VARCHAR), ''), lambda x: cast(ord(x) AS BIGINT))"
_TRIE = f"""
    WITH placed AS (
      SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k
      FROM conversations),
    convs AS (SELECT DISTINCT c, {_crc32(_DIGITS)} % 9 AS h FROM placed),
    turns AS (
      SELECT x.c, k, role, text FROM convs x JOIN placed p ON p.c = x.c - x.c % 5 AND k <= h
      UNION ALL
      SELECT x.c, k + 1000000000, role, text FROM convs x JOIN placed p ON p.c = x.c AND k > h),
    named AS (
      SELECT c, strlen(text) AS bytes, sha256(role || chr(10) || text) AS symbol,
             row_number() OVER (PARTITION BY c ORDER BY k) AS d
      FROM turns),
    prefixes AS (
      SELECT c, d, bytes, max(d) OVER (PARTITION BY c) AS n,
             sha256(string_agg(symbol, '') OVER (PARTITION BY c ORDER BY d)) AS node,
             sha256(coalesce(string_agg(symbol, '') OVER (PARTITION BY c ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '')) AS above
      FROM named
      UNION ALL
      SELECT c, 0, 0, coalesce((SELECT max(d) FROM named WHERE named.c = convs.c), 0), sha256(''), NULL FROM convs),
    nodes AS (
      SELECT node, any_value(above) AS above, d AS depth, min(c) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes,
             sha256(coalesce(string_agg(cast(c AS VARCHAR), ',' ORDER BY c) FILTER (d = n), '')) AS ends_sha256
      FROM prefixes GROUP BY node, d),
    fans AS (SELECT above AS node, count(*) AS n_children FROM nodes GROUP BY 1),
    told AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN fans USING (node)),
    spans AS (
      SELECT DISTINCT up.node AS top, below.node AS node
      FROM prefixes up JOIN prefixes below ON up.c = below.c AND up.d <= below.d),
    sums AS (
      SELECT top AS node, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * bytes) AS saved
      FROM spans JOIN told USING (node) GROUP BY 1)
    SELECT t.conv_id, cast(t.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, t.n_convs, t.n_children, n_leaves,
           cast(saved AS BIGINT) AS saved_tokens, t.ends_sha256
    FROM told t JOIN sums USING (node) LEFT JOIN told p ON p.node = t.above
"""

_CODES = """flatten(list_transform(string_split(doc_id || ':' || run, ''),
    lambda x: CASE WHEN ord(x) < 128 THEN [cast(ord(x) AS BIGINT)] ELSE [195, cast(ord(x) AS BIGINT) - 64] END))"""
_VARIANTS = f"""
    WITH RECURSIVE found AS (
      SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), {_UPPER}, {_LOWER}), '[a-zÀ-ÿ]+')) AS run FROM documents),
    counted AS (SELECT doc_id, run, count(*) AS n FROM found WHERE length(run) >= 5 GROUP BY 1, 2),
    coded AS (SELECT run, n, {_crc32(_CODES)} AS h FROM counted),
    changed AS (
      SELECT n, CASE WHEN h % 97 = 0 THEN left(run, cast(h % length(run) AS BIGINT)) || substr(run, cast(h % length(run) + 2 AS BIGINT)) ELSE run END AS word
      FROM coded),
    words AS (SELECT word, cast(sum(n) AS BIGINT) AS n FROM changed WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
    holes AS (SELECT word, n, i, left(word, i) || '_' || substr(word, i + 2) AS swapped, left(word, i) || substr(word, i + 2) AS shorter
      FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words) x),
    pairs AS (
      SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM holes a JOIN holes b ON a.swapped = b.swapped AND a.i = b.i AND a.word <> b.word
      UNION SELECT a.word, a.n, b.word, b.n FROM holes a JOIN words b ON a.shorter = b.word
      UNION SELECT b.word, b.n, a.word, a.n FROM holes a JOIN words b ON a.shorter = b.word),
    near AS (SELECT word, count(*) AS n_near, min((-other_n, other)) AS best FROM pairs GROUP BY word),
    told AS (
      SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN -best[1] >= 2 * w.n THEN best[2] END AS form,
             CASE WHEN -best[1] >= 2 * w.n THEN -best[1] END AS form_n
      FROM words w LEFT JOIN near USING (word)),
    walk AS (SELECT word, word AS root FROM told UNION ALL SELECT k.word, t.form FROM walk k JOIN told t ON t.word = k.root WHERE t.form IS NOT NULL)
    SELECT t.word, t.form, k.root, t.n, t.n_near, cast(t.form_n AS BIGINT) AS form_n
    FROM told t JOIN walk k USING (word) JOIN told e ON e.word = k.root AND e.form IS NULL
"""

ORACLE_SQL = {
    "op1_chat_format": _chat(),
    "op2_quality_rules": _quality(),
    "op6_jaccard_join": _JACCARD,
    "op8_source_mix": _MIX,
    "op9_line_dedup": _LINES,
    "op10_substring_dedup": _PASSAGES,
    "op11_warc_normalise": _ARCHIVES,
    "op12_spelling_variants": _VARIANTS,
    "op13_prefix_trie": _TRIE,
}
