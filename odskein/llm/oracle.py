"""DuckDB twins of the queries that SQL can express."""

from odskein.llm.chat import CONTROLS, DONE, SAYS, SIGN, TURN
from odskein.llm.license_scan import NOTICES, PHRASES, SLACK
from odskein.llm.quality_rules import STOP_WORDS, SYMBOLS

SPACES = r"[ \t\n\x0B\f\r]+"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str, between: str) -> str:
    return f"list_filter(string_split_regex({text}, '{between}'), lambda w: w <> '')"


def _alternatives(strings) -> str:
    quoted = ["".join("\\" + c if not c.isalnum() else c for c in s) for s in sorted(strings, key=len, reverse=True)]
    return "|".join(quoted)


def _escaped(column: str) -> str:
    """The text with the escape sign after the first character of every control string."""
    heads = sorted({c[0] for c in CONTROLS})
    text = f"replace(coalesce({column}, ''), '{SIGN}', '{SIGN}e')"
    for head in heads:
        rests = _alternatives(c[1:] for c in CONTROLS if c[0] == head)
        text = f"regexp_replace({text}, '(\\{head})({rests})', '\\1{SIGN}i\\2', 'g')"
    return text


_MARKS = len(TURN) + len(SAYS) + len(DONE)

CHAT = f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id,
    count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
    sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
    CAST(sum({_MARKS} + length({_escaped('role')}) + length({_escaped('text')})) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""

DECONTAMINATION = f"""
WITH docs AS (
    SELECT doc_id, {_words(f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')", BETWEEN)} AS words FROM documents
), items AS (
    SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
        {_words(f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')", BETWEEN)} AS words FROM benchmark
), windows AS (
    SELECT DISTINCT item, least(len(words), 10) AS n, array_to_string(words[i : i + least(len(words), 10) - 1], ' ') AS spelled
    FROM (SELECT item, words, unnest(generate_series(1, greatest(len(words) - 9, 1))) AS i FROM items WHERE len(words) > 0)
), widths AS (SELECT DISTINCT n FROM windows),
places AS (
    SELECT doc_id, n, i, array_to_string(words[i : i + n - 1], ' ') AS spelled
    FROM (SELECT doc_id, n, words, unnest(generate_series(1, len(words) - n + 1)) AS i FROM docs, widths WHERE len(words) >= n)
), hits AS (SELECT doc_id, i, n, item FROM places JOIN windows USING (n, spelled)),
covered AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS pos FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""

WARC = """
WITH payloads AS (
    SELECT page_id, coalesce(html, '') AS html, sha256(coalesce(html, '')) AS payload_digest, strlen(coalesce(html, '')) AS payload_bytes FROM pages
), firsts AS (SELECT html, min(page_id) AS first FROM payloads WHERE payload_bytes >= 100 GROUP BY html)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
    CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN first < page_id THEN first END AS refers_to
FROM payloads LEFT JOIN firsts USING (html)
"""

_SYMBOL_CLASS = "[" + "".join("\\" + c for c in SYMBOLS) + "]"
_STOPS = ", ".join(f"'{form(w)}'" for form in (str, str.capitalize) for w in dict.fromkeys(STOP_WORDS))

QUALITY_RULES = f"""
WITH docs AS (
    SELECT doc_id, text, words, list_filter(string_split(text, chr(10)), lambda line: regexp_matches(line, '[^ \\t\\n\\x0B\\f\\r]')) AS lines
    FROM (SELECT doc_id, coalesce(text, '') AS text, {_words("coalesce(text, '')", SPACES)} AS words FROM documents)
), windows AS (
    SELECT doc_id, i, words[i : i + 7] AS spelled FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 7)) AS i FROM docs WHERE len(words) >= 8)
), repeated AS (
    SELECT doc_id, count(DISTINCT pos) AS n_repeat_words FROM (
        SELECT doc_id, unnest(generate_series(i, i + 7)) AS pos
        FROM windows JOIN (SELECT doc_id, spelled FROM windows GROUP BY ALL HAVING count(*) > 1) USING (doc_id, spelled)
    ) GROUP BY doc_id
), measured AS (
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
        CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
        CAST(length(text) - length(regexp_replace(text, '{_SYMBOL_CLASS}', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
        CAST(len(lines) AS BIGINT) AS n_lines,
        CAST(len(list_filter(lines, lambda line: rtrim(line, ' ') LIKE '%...' OR rtrim(line, ' ') LIKE '%…')) AS BIGINT) AS n_ellipsis_lines,
        CAST(len(list_filter(words, lambda w: w IN ({_STOPS}))) AS BIGINT) AS n_stop_words,
        CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
    FROM docs LEFT JOIN repeated USING (doc_id)
)
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words
        OR word_chars / n_words < 2 OR word_chars / n_words > 15 OR n_symbols / n_words > 0.1 OR n_stop_words / n_words < 0.02
        OR n_dup_lines / n_lines > 0.3 OR n_ellipsis_lines / n_lines > 0.3) AS kept
FROM measured
"""

_PHRASE_ROWS = ", ".join(f"('{phrase}', '{label}')" for phrase, label in PHRASES)


def _notice_row(label: str, text: str) -> str:
    """Label, words, width of a window, words all of which must be in it, and sets none of which may be in it whole."""
    words = set(text.split())
    rest = [set(other.split()) for name, other in NOTICES if name != label]
    own = set().union(*[words - other for other in rest if other < words])
    others = [other - words for other in rest if words < other]
    listed = lambda some: "[" + ", ".join(f"'{w}'" for w in sorted(some)) + "]::VARCHAR[]"
    width = len(text.split()) + len(text.split()) // SLACK
    sets = "[" + ", ".join(listed(o) for o in others) + "]::VARCHAR[][]"
    return f"('{label}', {listed(words)}, {width}, {listed(own)}, {sets})"


_NOTICE_ROWS = ", ".join(_notice_row(*notice) for notice in NOTICES)

LICENSE_SCAN = f"""
WITH docs AS (
    SELECT doc_id, text, {_words('text', BETWEEN)} AS words
    FROM (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS text FROM documents)
), phrases AS (
    SELECT label, string_split(phrase, ' ') AS said FROM (VALUES {_PHRASE_ROWS}) AS p(phrase, label)
), places AS (
    SELECT doc_id, i - 1 AS start, label
    FROM (SELECT doc_id, words, unnest(generate_series(1, len(words))) AS i FROM docs), phrases
    WHERE words[i : i + len(said) - 1] = said
), base AS (
    SELECT doc_id, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
    FROM places GROUP BY doc_id
), notices AS (
    SELECT *, CAST(ceil(0.8 * len(needs) - 1e-9) AS INTEGER) AS needed
    FROM (VALUES {_NOTICE_ROWS}) AS t(label, needs, width, own, others)
), near AS (
    SELECT doc_id, words, notices.* FROM docs, notices WHERE len(list_intersect(needs, words)) >= needed
), windows AS (
    SELECT doc_id, label, needs, needed, own, others, words[i : i + width - 1] AS held
    FROM (SELECT *, unnest(generate_series(1, len(words))) AS i FROM near)
), matches AS (
    SELECT doc_id, label, len(list_intersect(needs, held)) / len(needs) AS score FROM windows
    WHERE len(list_intersect(needs, held)) >= needed AND list_has_all(held, own)
        AND len(list_filter(others, lambda o: list_has_all(held, o))) = 0
), best AS (SELECT doc_id, max(score) AS score FROM matches GROUP BY doc_id),
every AS (
    SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
    FROM (SELECT doc_id, label FROM places UNION SELECT doc_id, label FROM matches) GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, first_word, last_word,
    coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
    CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(score, 0.0) END AS score
FROM docs LEFT JOIN base USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN every USING (doc_id)
"""

SUFFIX_DEDUP = """
WITH docs AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS spelled FROM documents
), parts AS ( -- 512 bytes and the 49 behind them, so that no string is cut out of a long one
    SELECT doc_id, c, length(spelled) // 2 AS n, substr(spelled, 1024 * c + 1, 1122) AS part
    FROM (SELECT doc_id, spelled, unnest(generate_series(0, (length(spelled) // 2 - 1) // 512)) AS c FROM docs WHERE length(spelled) > 0)
), places AS (
    SELECT doc_id, 512 * c + i AS p, substr(part, 2 * i - 1, 2) AS byte, CASE WHEN 512 * c + i + 49 <= n THEN substr(part, 2 * i - 1, 100) END AS string
    FROM (SELECT *, unnest(generate_series(1, least(512, n - 512 * c))) AS i FROM parts)
), repeated AS (
    SELECT string, min(doc_id) AS first FROM places WHERE string IS NOT NULL GROUP BY string HAVING min(doc_id) <> max(doc_id)
), marked AS (
    SELECT doc_id, p, byte, coalesce(p - max(CASE WHEN first < doc_id THEN p END) OVER (PARTITION BY doc_id ORDER BY p) < 50, false) AS gone
    FROM places LEFT JOIN repeated USING (string)
), turned AS (
    SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY p), false) AS starts FROM marked
), kept AS (
    SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed, count(*) FILTER (WHERE starts) AS n_spans,
        string_agg(byte, '' ORDER BY p) FILTER (WHERE NOT gone) AS rest
    FROM turned GROUP BY doc_id
)
SELECT doc_id, CAST(length(spelled) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
    sha256(unhex(coalesce(rest, ''))) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)
"""

LINE_DEDUP = f"""
WITH lines AS (
    SELECT doc_id, pos, said[pos] AS line,
        regexp_replace(regexp_replace(translate(said[pos], '{UPPER}', '{LOWER}'), '^{SPACES}', ''), '{SPACES}$', '') AS key
    FROM (SELECT doc_id, said, unnest(generate_series(1, len(said))) AS pos
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS said FROM documents))
), common AS (
    SELECT key, max(doc_id) AS keeper FROM lines WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), judged AS (
    SELECT doc_id, pos, line, keeper IS NOT NULL AND doc_id <> keeper AS lost FROM lines LEFT JOIN common USING (key)
)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE lost) AS BIGINT) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

LEXICAL_SEARCH = f"""
WITH docs AS (
    SELECT doc_id, {_words(f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')", BETWEEN)} AS words FROM documents
), totals AS (
    SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(len(words)) AS BIGINT) AS total FROM docs WHERE len(words) > 0
), asked AS (
    SELECT DISTINCT item_id, unnest({_words(f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')", BETWEEN)}) AS term FROM benchmark
), counts AS (
    SELECT doc_id, n, term, count(*) AS tf
    FROM (SELECT doc_id, len(words) AS n, unnest(words) AS term FROM docs) SEMI JOIN asked USING (term) GROUP BY ALL
), weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * any_value(totals.docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM counts, totals GROUP BY term
), scores AS (
    SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * totals.docs) // totals.total)))) AS BIGINT) AS score
    FROM asked JOIN counts USING (term) JOIN weights USING (term), totals GROUP BY item_id, doc_id
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place FROM scores WHERE score > 0
)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM ranked WHERE place <= 10
"""
