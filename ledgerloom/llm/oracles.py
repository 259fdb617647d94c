"""DuckDB SQL of the operators that SQL can express, over the same tables."""

from __future__ import annotations

from ledgerloom.llm.mixing import MOST_REPEATS, SHARE, WEIGHTS
from ledgerloom.llm.quality_rules import RULES, STOP_WORD_LANGUAGES, STOP_WORDS
from ledgerloom.llm.sharding import MULTIPLIER, ROWS_PER_SLICE

_BLANK = r"[\x20\x09-\x0D]"

_SQL_MEASURES = {
    "n_words": "n_words",
    "mean_word_chars": "coalesce(word_chars / nullif(n_words, 0), 0)",
    "symbols_per_word": "coalesce(n_symbols / nullif(n_words, 0), 0)",
    "stop_word_ratio": "coalesce(n_stop_words / nullif(n_words, 0), 0)",
    "upper_ratio": "coalesce(n_upper / nullif(word_chars, 0), 0)",
    "dup_line_ratio": "coalesce(n_dup_lines / nullif(n_lines, 0), 0)",
}


def _bounds() -> str:
    parts = []
    for rule in RULES:
        value = _SQL_MEASURES[rule.measure]
        if rule.low is not None:
            spared = " OR NOT speaks" if rule.measure == "stop_word_ratio" else ""
            parts.append(f"({value} >= {rule.low}{spared})")
        if rule.high is not None:
            parts.append(f"{value} <= {rule.high}")
    return " AND ".join(parts)


_STOP = ", ".join(f"'{word}'" for word in STOP_WORDS)

_LISTED = ", ".join(f"'{lang}'" for lang in STOP_WORD_LANGUAGES)

OP1 = f"""
WITH docs AS (
    SELECT row_number() OVER () AS n, doc_id, coalesce(text, '') AS t,
           lower(split_part(replace(trim(lang), '_', '-'), '-', 1)) AS lang
    FROM documents
),
split AS (
    SELECT *, list_filter(string_split_regex(t, '{_BLANK}+'), lambda w: w <> '') AS words,
           list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS lines
    FROM docs
),
placed AS (
    SELECT n, unnest(words) AS a, unnest(range(1, len(words) + 1)) AS i FROM split
),
windows AS (
    SELECT n, i, a, lead(a) OVER w AS b, lead(a, 2) OVER w AS c FROM placed WINDOW w AS (PARTITION BY n ORDER BY i)
),
grams AS (
    SELECT n, i, count(*) OVER (PARTITION BY n, a, b, c) AS times FROM windows WHERE c IS NOT NULL
),
repeated AS (
    SELECT n, count(DISTINCT i + step) AS n_repeat_words
    FROM grams, (SELECT unnest([0, 1, 2]) AS step) WHERE times > 1 GROUP BY n
),
measured AS (
    SELECT doc_id, len(words)::BIGINT AS n_words,
           coalesce(list_sum(list_transform(words, lambda w: length(w))), 0)::BIGINT AS word_chars,
           (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
           len(lines)::BIGINT AS n_lines,
           (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
           coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
           len(list_filter(string_split_regex(lower(t), '[\\x20\\x09-\\x0D.,;:!?]+'),
                           lambda w: w IN ({_STOP}))) AS n_stop_words,
           length(t) - length(regexp_replace(t, '\\p{{Lu}}', '', 'g')) AS n_upper,
           length(t) - length(regexp_replace(t, '[^\\P{{L}}\\p{{Latin}}]', '', 'g')) AS n_other_letters,
           lang
    FROM split LEFT JOIN repeated USING (n)
),
judged AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
           CASE WHEN coalesce(lang, '') IN ('', 'und') THEN 2 * n_other_letters < word_chars
                ELSE lang IN ({_LISTED}) END AS speaks
    FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {_bounds()} AS kept
FROM judged
"""

OP8 = f"""
WITH docs AS (
    SELECT doc_id, source,
           len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
           ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || chr(31) || coalesce(text, '')), 1, 12))::BIGINT
               AS hash
    FROM documents
),
sizes AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           ([{", ".join(f"{w}::DOUBLE" for w in WEIGHTS)}])[
               (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1] AS weight
    FROM docs GROUP BY source
),
limits AS (
    SELECT *, source_size * {float(MOST_REPEATS)}::DOUBLE AS lim,
           source_size * {float(MOST_REPEATS)}::DOUBLE / weight AS level,
           sum(source_size) OVER () * {SHARE}::DOUBLE AS budget
    FROM sizes
),
rates AS (
    SELECT *, (budget - coalesce(sum(lim) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
               / sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rate
    FROM limits WINDOW w AS (ORDER BY level, source NULLS LAST)
),
opened AS (
    SELECT *, (SELECT rate FROM rates WHERE level > rate ORDER BY level, source NULLS LAST LIMIT 1) AS open_rate
    FROM rates
),
targets AS (
    SELECT source, source_size, least(lim, coalesce(open_rate * weight, lim)) AS target FROM opened
),
budgets AS (
    SELECT *, coalesce(floor(target / nullif(source_size, 0)), 0)::BIGINT AS rounds,
           target - coalesce(floor(target / nullif(source_size, 0)), 0) * source_size AS rest
    FROM targets
),
cells AS (
    SELECT source, hash, sum(size) AS words, max(size) AS one,
           coalesce(sum(sum(size)) OVER (PARTITION BY source ORDER BY hash
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
    FROM docs WHERE size > 0 GROUP BY source, hash
),
edges AS (
    SELECT b.source, c.hash AS threshold, floor((rest - below) / one + 0.5) AS at_threshold
    FROM cells c JOIN budgets b ON c.source IS NOT DISTINCT FROM b.source
    WHERE below < rest AND rest <= below + words
)
SELECT d.doc_id, d.size, b.source_size, b.target,
       (d.size * (b.rounds + CASE
           WHEN d.hash < e.threshold THEN 1
           WHEN d.hash = e.threshold AND row_number() OVER (
               PARTITION BY d.source, d.hash ORDER BY d.size DESC) <= e.at_threshold THEN 1
           ELSE 0 END))::BIGINT AS taken
FROM docs d JOIN budgets b ON d.source IS NOT DISTINCT FROM b.source
LEFT JOIN edges e ON d.source IS NOT DISTINCT FROM e.source
"""

# The checksum walks over the bytes of each text with the table of the CRC-32 polynomial.
OP2 = f"""
WITH RECURSIVE entry(i, c, k) AS (
    SELECT i, i::BIGINT, 0 FROM range(256) r(i)
    UNION ALL
    SELECT i, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM entry WHERE k < 8
),
crc_table AS (SELECT list(c ORDER BY i) AS entries FROM entry WHERE k = 8),
docs AS (
    SELECT row_number() OVER () AS n, doc_id, strlen(coalesce(text, '')) + 1 AS size,
           string_split(hex(coalesce(text, '')), '') AS h
    FROM documents
),
sums AS (
    SELECT n, doc_id, size, xor(list_reduce(
               list_prepend(4294967295::BIGINT, list_transform(range(size - 1), lambda i: (
                   (instr('0123456789ABCDEF', h[2 * i + 1]) - 1) * 16
                   + instr('0123456789ABCDEF', h[2 * i + 2]) - 1)::BIGINT)),
               lambda c, b: xor(c >> 8, entries[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32
    FROM docs, crc_table
),
jump(n, state, place, shard, grown) AS (
    SELECT n, (coalesce(doc_id, text_crc32)::HUGEINT + {2**64}) % {2**64}, 0::BIGINT, 0::BIGINT, 0::BIGINT FROM sums
    UNION ALL
    SELECT n, following,
           floor((place + 1)::DOUBLE * (2147483648::DOUBLE / (following // {2**33} + 1)::DOUBLE))::BIGINT,
           CASE WHEN place < 8 THEN place ELSE shard END, place
    FROM (SELECT *, (state * {MULTIPLIER}::HUGEINT + 1) % {2**64} AS following FROM jump WHERE place < 9)
),
placed AS (SELECT n, shard, grown FROM jump WHERE place >= 9),
sliced AS (
    SELECT sums.*, shard, grown,
           ('0x' || substr(md5(coalesce(doc_id, text_crc32)::VARCHAR), 1, 8))::BIGINT
               % greatest(1, ceil(count(*) OVER () / {ROWS_PER_SLICE * 8}.0))::BIGINT AS slice
    FROM sums JOIN placed USING (n)
)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'key' AS law, shard::INTEGER AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY slice, doc_id NULLS FIRST, text_crc32, size) - 1 AS slot,
       grown::INTEGER AS grown_shard
FROM sliced
"""

_TERMS = """regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"""

OP13 = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS words FROM documents),
items AS (SELECT row_number() OVER () AS q, item_id, {_TERMS} AS words FROM benchmark),
totals AS (
    SELECT count(*) FILTER (len(words) > 0)::BIGINT AS n_docs, sum(len(words))::BIGINT AS n_terms FROM docs
),
asked AS (
    SELECT q, item_id, term, count(*) AS times FROM (SELECT q, item_id, unnest(words) AS term FROM items) GROUP BY ALL
),
found AS (
    SELECT r, doc_id, n, term, count(*) AS tf
    FROM (SELECT r, doc_id, len(words) AS n, unnest(words) AS term FROM docs)
    WHERE term IN (SELECT term FROM asked) GROUP BY ALL
),
weights AS (
    SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS weight
    FROM found, totals GROUP BY term, n_docs
),
scores AS (
    SELECT q, item_id, r, doc_id,
           sum(times * weight * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms))))::BIGINT
               AS score
    FROM asked JOIN found USING (term) JOIN weights USING (term), totals GROUP BY ALL
),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS place
    FROM scores WHERE score > 0
)
SELECT item_id, place::INTEGER AS rank, doc_id, score FROM placed WHERE place <= 10
"""

ORACLES = {"op1_quality_rules": OP1, "op2_jump_sharding": OP2, "op8_mixing": OP8, "op13_lexical_search": OP13}
