"""SQL equivalents of text queries, by brute force where the operators take a shorter way."""

from __future__ import annotations

WORDS = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"

# Measure, numerator and denominator in thousandths, least spread, whether low values count.
_MEASURES = (
    ("symbol_share", "1000 * n_symbols // n_words", 30, False),
    ("dup_line_share", "1000 * n_dup_lines // n_lines", 120, False),
    ("repeat_share", "1000 * n_repeat_words // n_words", 100, False),
    ("capital_share", "1000 * capitals // greatest(1, capitals + small)", 60, False),
    ("shout_share", "1000 * shouts // n_words", 20, False),
    ("word_length", "1000 * word_chars // n_words", 500, True),
)


def _without(characters: str) -> str:
    return f"(length(t) - length(regexp_replace(t, '[{characters}]', '', 'g')))"


def quality_rules() -> str:
    values = " UNION ALL ".join(
        f"SELECT lang, source, '{name}' AS measure, {value} AS v FROM base WHERE n_words > 0"
        for name, value, _, _ in _MEASURES
    )
    spreads = ", ".join(f"('{name}', {spread}, {low})" for name, _, spread, low in _MEASURES)
    checks = " UNION ALL ".join(
        f"SELECT r, {i} AS k, '{name}' AS measure, {value} AS v, lang, source FROM base WHERE n_words > 0"
        for i, (name, value, _, _) in enumerate(_MEASURES)
    )
    ranked = """SELECT *, sum(n) OVER (PARTITION BY {0}, measure) AS total,
                       sum(n) OVER (PARTITION BY {0}, measure ORDER BY b) AS below FROM {1}"""
    cut = """SELECT {0}, q.measure, max(total) AS n_rows,
                    min(CASE WHEN below * 100 >= total * 50 THEN b END) AS median,
                    min(CASE WHEN below * 100 >= total * 5 THEN b END) AS lower
             FROM ({1}) q GROUP BY ALL"""
    limits = """SELECT {0}, c.measure, n_rows, median + 4 * greatest(median - lower, spread) AS high,
                       CASE WHEN low_too THEN median - 4 * greatest(median - lower, spread) ELSE -1 END AS low
                FROM ({1}) c JOIN spreads USING (measure)"""
    by_source = limits.format("lang, source", cut.format("lang, source", ranked.format("lang, source", "buckets")))
    merged = "(SELECT lang, measure, b, sum(n) AS n FROM buckets GROUP BY ALL)"
    by_lang = limits.format("lang", cut.format("lang", ranked.format("lang", merged)))
    return rf"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
    s AS (SELECT *, {WORDS.format('t')} AS ws,
                 list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
    grams AS (SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS gram
              FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM s)),
    often AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS n FROM grams) WHERE n > 1),
    repeats AS (SELECT r, count(DISTINCT place) AS n FROM (
                  SELECT r, unnest([i, i + 1, i + 2]) AS place FROM often) GROUP BY r),
    base AS (SELECT s.r, doc_id, lang, source, CAST(len(ws) AS BIGINT) AS n_words,
                    CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
                    CAST({_without('#*$%&|<>')} AS BIGINT) AS n_symbols,
                    CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, len(ls) AS n_lines,
                    CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
                    {_without('A-Z')} AS capitals, {_without('a-z')} AS small, {_without('!')} AS shouts
             FROM s LEFT JOIN repeats ON repeats.r = s.r),
    spreads(measure, spread, low_too) AS (VALUES {spreads}),
    vals AS ({values}),
    buckets AS (SELECT lang, source, measure, (v >> sh) << sh AS b, count(*) AS n FROM (
                  SELECT *, greatest(length(bin(CAST(v AS BIGINT))) - 6, 0) AS sh FROM vals) GROUP BY ALL),
    by_source AS ({by_source}),
    by_lang AS ({by_lang}),
    lim AS (SELECT a.lang, a.source, a.measure, CASE WHEN a.n_rows < 100 THEN l.high ELSE a.high END AS high,
                   CASE WHEN a.n_rows < 100 THEN l.low ELSE a.low END AS low
            FROM by_source a JOIN by_lang l ON a.lang IS NOT DISTINCT FROM l.lang AND a.measure = l.measure),
    failing AS (SELECT r, string_agg(c.measure, ',' ORDER BY k) AS failed FROM ({checks}) c JOIN lim
                ON c.lang IS NOT DISTINCT FROM lim.lang AND c.source IS NOT DISTINCT FROM lim.source
                   AND c.measure = lim.measure
                WHERE v > high OR v < low GROUP BY r),
    judged AS (SELECT base.*, coalesce(failed, '') AS failed,
                      n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed
               FROM base LEFT JOIN failing ON failing.r = base.r)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND failed = '' AS kept, failed
    FROM judged"""


def near_duplicates() -> str:
    """All pairs that share a shingle, compared exactly."""
    return rf"""
    WITH RECURSIVE texts AS (SELECT text, min(doc_id) AS node, count(*) AS copies FROM documents
                             WHERE regexp_matches(text, '[^\x20\x09-\x0D]') GROUP BY text),
    split AS (SELECT node, {WORDS.format('lower(text)')} AS ws FROM texts),
    grams AS (SELECT node, array_to_string(ws[i:i + 4], ' ') AS g
              FROM (SELECT node, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM split)),
    sets AS (SELECT node, g, 1 + log2(count(*)) AS w FROM grams GROUP BY ALL),
    sizes AS (SELECT node, count(*) AS n, max(w) > 1 AS heavy FROM sets GROUP BY node),
    shared AS (SELECT a.node AS a, b.node AS b, count(*) AS n FROM sets a JOIN sets b
               ON a.g = b.g AND a.node < b.node GROUP BY ALL),
    plain AS (SELECT a, b, shared.n / (x.n + y.n - shared.n) AS j, x.heavy OR y.heavy AS heavy
              FROM shared JOIN sizes x ON x.node = a JOIN sizes y ON y.node = b),
    near AS (SELECT a, b FROM plain WHERE j >= 0.5 AND j < 0.8 AND heavy),
    either AS (SELECT near.a, near.b, g, max(CASE WHEN node = near.a THEN w ELSE 0 END) AS wa,
                      max(CASE WHEN node = near.b THEN w ELSE 0 END) AS wb
               FROM near JOIN sets ON node IN (near.a, near.b) GROUP BY ALL),
    probability AS (SELECT a, b, sum(1 / s) AS j FROM (
                      SELECT x.a, x.b, x.g, sum(greatest(u.wa / x.wa, u.wb / x.wb)) AS s
                      FROM either x JOIN either u ON u.a = x.a AND u.b = x.b
                      WHERE x.wa > 0 AND x.wb > 0 GROUP BY ALL) GROUP BY a, b),
    links AS (SELECT a, b FROM plain WHERE j >= 0.8 UNION SELECT a, b FROM probability WHERE j >= 0.8),
    edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
    reach AS (SELECT node, node AS root FROM texts UNION
              SELECT edges.b, reach.root FROM reach JOIN edges ON edges.a = reach.node),
    roots AS (SELECT node, min(root) AS root FROM reach GROUP BY node),
    whole AS (SELECT root, min(roots.node) AS class_id, CAST(sum(copies) AS BIGINT) AS class_size
              FROM roots JOIN texts ON texts.node = roots.node GROUP BY root)
    SELECT doc_id, coalesce(class_id, doc_id) AS class_id, coalesce(class_size, 1) AS class_size
    FROM documents LEFT JOIN texts ON texts.text = documents.text
    LEFT JOIN roots ON roots.node = texts.node LEFT JOIN whole ON whole.root = roots.root"""


def quotation_linking() -> str:
    quote = r"'^((?:[ \t]*>)+)'"
    attribution = r"'^[^>].{0,200}(?:wrote|writes|schrieb|a écrit|escribió).{0,80}:[ \t]*$'"
    return rf"""
    WITH RECURSIVE l AS (
      SELECT conv_id, turn, pos, line, regexp_extract(line, {quote}, 1) AS p, regexp_replace(line, {quote}, '') AS body
      FROM (SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS line,
                   generate_subscripts(string_split(text, chr(10)), 1) AS pos
            FROM conversations WHERE text IS NOT NULL)),
    levels AS (SELECT *, length(p) - length(replace(p, '>', '')) AS level FROM l),
    runs AS (SELECT *, sum(changed) OVER (PARTITION BY conv_id, turn ORDER BY pos) AS run FROM (
               SELECT *, CASE WHEN level <> lag(level) OVER (PARTITION BY conv_id, turn ORDER BY pos)
                              THEN 1 ELSE 0 END AS changed FROM levels)),
    passages AS (SELECT conv_id, turn, level, string_agg(body, ' ' ORDER BY pos) AS body FROM runs
                 GROUP BY conv_id, turn, run, level),
    raw AS (SELECT conv_id, turn, level, body FROM levels UNION ALL SELECT * FROM passages UNION ALL
            SELECT conv_id, turn, level, unnest(regexp_extract_all(body, '[^.!?]+[.!?]*')) FROM passages),
    units AS (SELECT DISTINCT conv_id, turn, level, trim(regexp_replace(lower(body), '[\x00-\x20]+', ' ', 'g')) AS unit
              FROM raw),
    quoted AS (SELECT q.conv_id, q.turn, q.level, q.unit, max(o.turn) AS origin
               FROM units q LEFT JOIN units o ON o.conv_id = q.conv_id AND o.unit = q.unit AND o.level = 0
                    AND o.turn < q.turn
               WHERE q.level > 0 AND length(q.unit) >= 1 GROUP BY ALL),
    votes AS (SELECT conv_id, turn, origin, sum(length(unit)) AS chars FROM quoted
              WHERE level = 1 AND origin IS NOT NULL GROUP BY ALL),
    best AS (SELECT conv_id, turn, max((chars, origin))[2] AS origin FROM votes GROUP BY ALL),
    tree AS (SELECT c.conv_id, c.turn, coalesce(best.origin, lag(c.turn) OVER (PARTITION BY c.conv_id ORDER BY c.turn)) AS parent,
                    best.origin IS NOT NULL AS linked
             FROM conversations c LEFT JOIN best ON best.conv_id = c.conv_id AND best.turn = c.turn),
    paths AS (SELECT conv_id, turn, [turn] AS path FROM tree WHERE parent IS NULL UNION ALL
              SELECT tree.conv_id, tree.turn, list_append(paths.path, tree.turn)
              FROM paths JOIN tree ON tree.conv_id = paths.conv_id AND tree.parent = paths.turn),
    positions AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY path) AS position FROM paths),
    origins AS (SELECT conv_id, turn, count(DISTINCT origin) AS n FROM quoted GROUP BY ALL),
    marked AS (SELECT *, lead(level) OVER (PARTITION BY conv_id, turn ORDER BY pos) > 0
                         AND regexp_matches(line, {attribution}) AS introduces FROM levels),
    own AS (SELECT conv_id, turn, count_if(level > 0) AS n_quoted,
                   string_agg(CASE WHEN level = 0 AND NOT coalesce(introduces, false) THEN line END, chr(10) ORDER BY pos) AS t
            FROM marked GROUP BY ALL)
    SELECT c.conv_id, position, c.turn, c.role, tree.parent AS reply_to, linked,
           CAST(coalesce(n_quoted, 0) AS BIGINT) AS n_quoted, CAST(coalesce(origins.n, 0) AS BIGINT) AS n_origins,
           CASE WHEN c.text IS NOT NULL THEN
             regexp_replace(coalesce(t, ''), '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g') END AS text
    FROM conversations c JOIN tree USING (conv_id, turn) JOIN positions USING (conv_id, turn)
    LEFT JOIN origins USING (conv_id, turn) LEFT JOIN own USING (conv_id, turn)"""


def collocations() -> str:
    """All phrases of up to four words, counted."""
    return r"""
    WITH p AS (SELECT coalesce(lang, 'und') AS lang,
                      unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                             'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
               FROM documents),
    w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
    places AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
    sizes AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang),
    grams AS (SELECT lang, ws[i:i + k] AS g FROM places, range(4) AS steps(k) WHERE i + k <= len(ws)),
    f AS (SELECT lang, g, CAST(count(*) AS BIGINT) AS f FROM grams GROUP BY ALL HAVING count(*) >= 30),
    cand AS (SELECT * FROM f WHERE len(g) > 1),
    inner_parts AS (
      SELECT lang, g[1:len(g) - 1] AS g, f FROM cand WHERE len(g) > 2 UNION ALL
      SELECT lang, g[2:] AS g, f FROM cand WHERE len(g) > 2 UNION ALL
      SELECT lang, g[1:2] AS g, f FROM cand WHERE len(g) = 4 UNION ALL
      SELECT lang, g[2:3] AS g, f FROM cand WHERE len(g) = 4 UNION ALL
      SELECT lang, g[3:] AS g, f FROM cand WHERE len(g) = 4),
    longer AS (SELECT lang, g, max(f) AS f FROM inner_parts GROUP BY ALL),
    cuts AS (SELECT lang, g, f AS a, unnest(range(1, len(g))) AS k FROM cand),
    scored AS (SELECT cuts.lang, cuts.g, a, k, x.f AS l, y.f AS r, CAST(CAST(2000000 AS HUGEINT) * a // (x.f + y.f) AS BIGINT) AS score
               FROM cuts JOIN f x ON x.lang = cuts.lang AND x.g = cuts.g[1:k]
               JOIN f y ON y.lang = cuts.lang AND y.g = cuts.g[k + 1:]),
    best AS (SELECT lang, g, a, min((score, k, l, r)) AS cut FROM scored GROUP BY ALL),
    kept AS (SELECT best.lang, array_to_string(best.g, ' ') AS phrase, a, cut[3] AS l, cut[4] AS r, cut[1] AS score
             FROM best LEFT JOIN longer ON longer.lang = best.lang AND longer.g = best.g
             WHERE longer.f IS NULL OR CAST(100 AS HUGEINT) * longer.f < CAST(80 AS HUGEINT) * a)
    SELECT kept.lang, rank, phrase, a, l, r, n, score
    FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) kept
    JOIN sizes ON sizes.lang = kept.lang WHERE rank <= 2000"""
