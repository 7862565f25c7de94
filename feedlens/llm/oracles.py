"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_NEAREST = """
WITH whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
    FROM whole q JOIN whole c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id
), ranked AS (
    SELECT query_id, vec_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""

_CHAT = r"""
WITH given AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok'))
), numbered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS number,
           4 + len(regexp_extract_all(text, '[\p{L}\p{N}]+|[^\s\p{L}\p{N}]')) AS tokens,
           4 + length(regexp_replace(role, '([\\#<:])', '\\\1', 'g')) + 2
             + length(regexp_replace(text, '([\\#<])', '\\\1', 'g')) + 8 AS piece
    FROM given
), marked AS (
    SELECT *, number = 1 AND role = 'system' AS is_system FROM numbered
), summed AS (
    SELECT *, sum(CASE WHEN is_system THEN 0 ELSE tokens END) OVER w - CASE WHEN is_system THEN 0 ELSE tokens END AS before,
           max(CASE WHEN is_system THEN tokens END) OVER (PARTITION BY conv_id) AS system_tokens,
           max(CASE WHEN is_system THEN piece END) OVER (PARTITION BY conv_id) AS system_piece
    FROM marked WINDOW w AS (PARTITION BY conv_id ORDER BY number)
), roomed AS (
    SELECT *, greatest(floor((512 - 128 - coalesce(system_tokens, 0)) / 2.0), 1) AS room FROM summed
), stepped AS (
    SELECT *, floor(before / room) AS step, NOT is_system AND tokens > room AS long FROM roomed
), opened AS (
    SELECT *, lag(number) OVER w IS NULL OR (NOT lag(is_system) OVER w AND (long OR lag(long) OVER w OR step > lag(step) OVER w)) AS opens
    FROM stepped WINDOW w AS (PARTITION BY conv_id ORDER BY number)
), windowed AS (
    SELECT *, sum(CAST(opens AS INTEGER)) OVER (PARTITION BY conv_id ORDER BY number) - 1 AS win FROM opened
), repeats AS (
    SELECT o.conv_id, sum(t.piece) AS chars
    FROM windowed o JOIN windowed t ON o.conv_id IS NOT DISTINCT FROM t.conv_id AND NOT t.is_system
     AND t.before >= o.before - 128 AND t.before <= o.before - 1
    WHERE o.opens GROUP BY o.conv_id
)
SELECT w.conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY number)) AS turns_sha256,
       CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY number), '')) AS loss_sha256,
       CAST(sum(piece) + coalesce(max(r.chars), 0) + coalesce(max(system_piece), 0) * max(win) AS BIGINT) AS formatted_chars
FROM windowed w LEFT JOIN repeats r ON w.conv_id IS NOT DISTINCT FROM r.conv_id
GROUP BY w.conv_id
"""

_CONTAMINATION = r"""
WITH doc AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), item AS (
    SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
    SELECT DISTINCT item, least(13, len(w)) AS n, array_to_string(list_slice(w, pos, pos + least(13, len(w)) - 1), ' ') AS words
    FROM (SELECT item, w, unnest(generate_series(1, greatest(1, len(w) - 12))) AS pos FROM item WHERE len(w) > 0)
), sizes AS (
    SELECT DISTINCT n FROM windows
), grams AS (
    SELECT doc_id, pos, n, array_to_string(list_slice(w, pos, pos + n - 1), ' ') AS words
    FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS pos FROM doc, sizes WHERE len(w) >= n)
), found AS (
    SELECT doc_id, pos, n, item FROM grams JOIN windows USING (n, words)
), hits AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit
    FROM (SELECT doc_id, unnest(generate_series(pos, pos + n - 1)) AS place FROM found) GROUP BY doc_id
), items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
    FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id
)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_MIX = r"""
WITH sized AS (
    SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
           CAST(('0x' || md5(coalesce(CAST(doc_id AS VARCHAR), '') || '#0')[:13]) AS BIGINT) AS key
    FROM documents
), sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size, 2 * CAST(sum(size) AS BIGINT) AS cap,
           [5, 2, 1][1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3] AS weight
    FROM sized GROUP BY source
), levels AS (
    SELECT *, coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS caps_before,
           (CAST(sum(source_size) OVER () * 150 AS DOUBLE) / 100.0
            - CAST(coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE))
           / CAST(sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
    FROM sources WINDOW o AS (ORDER BY cap * (10 // weight), source IS NULL, source)
), targets AS (
    SELECT source, source_size,
           least(CAST(cap AS DOUBLE), coalesce(weight * (SELECT arg_min(level, caps_before) FROM levels WHERE level * weight <= cap), CAST(cap AS DOUBLE))) AS target
    FROM levels
), joined AS (
    SELECT s.*, t.source_size, t.target, CAST(floor(t.target) AS BIGINT) AS budget,
           sum(size) OVER (PARTITION BY s.source ORDER BY key, doc_id NULLS FIRST, size) - size AS before
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       CASE WHEN size = 0 THEN 0 ELSE CAST((budget // source_size) * size + least(size, greatest(0, budget % source_size - before)) AS BIGINT) END AS taken
FROM joined
"""

_SECRETS = r"""
WITH doc AS (
    SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS text FROM documents
), forms(ord, kind, pattern) AS (VALUES
    (0, 'assign', '(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9+/_.=-]+'),
    (1, 'access', 'AKIA[A-Z0-9]+'), (2, 'hex', '[0-9a-f]+'), (3, 'entropy', '[A-Za-z0-9+/_=-]+')
), matched AS (
    SELECT r, ord, kind, regexp_extract_all(text, pattern) AS found, regexp_split_to_array(text, pattern) AS gaps
    FROM doc, forms
), spans AS (
    SELECT r, ord, kind, found[pos] AS found,
           list_sum(list_transform(gaps[:pos], lambda x: length(x))) + coalesce(list_sum(list_transform(found[:pos - 1], lambda x: length(x))), 0) AS start
    FROM (SELECT *, unnest(generate_series(1, len(found))) AS pos FROM matched)
    WHERE length(found[pos]) >= 12
), base AS (
    SELECT r, ord, kind, start, start + length(found) AS stop FROM spans
    WHERE (ord = 0 AND length(regexp_extract(found, '^[A-Za-z_]+?["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)$', 1)) >= 6)
       OR (ord = 1 AND length(found) >= 20) OR (ord = 2 AND length(found) >= 24)
), masked AS (
    SELECT r, start, found, array_to_string(list_transform(regexp_extract_all(
             regexp_replace(found, '[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}', repeat('.', 36), 'g'), '[A-Za-z0-9]+|[^A-Za-z0-9]+'),
             lambda part: CASE WHEN regexp_matches(part, '^(?:[A-Z]{4,}|[A-Z]?[a-z]{3,}(?:[A-Z][a-z]+)*)$')
               OR regexp_matches(part, '(?i)example|placeholder|sample|dummy|xxxx|changeme|abcdefgh|0123456789')
             THEN repeat('.', length(part)) ELSE part END), '') AS held
    FROM spans WHERE ord = 3 AND length(found) >= 20
), windows AS (
    SELECT * FROM (SELECT r, start, found, held, unnest(generate_series(0, length(found) - 20)) AS pos FROM masked)
    WHERE NOT contains(substr(held, pos + 1, 20), '.')
), letters AS (
    SELECT r, start, pos, regexp_matches(found, '^[0-9a-fA-F]+$') AS hexa, letter, count(*) AS n
    FROM (SELECT *, unnest(string_split(substr(found, pos + 1, 20), '')) AS letter FROM windows) GROUP BY ALL
), hot AS (
    SELECT r, start + pos AS a, start + pos + 20 AS b FROM letters GROUP BY r, start, pos, hexa
    HAVING log2(20) - sum(n * log2(n)) / 20 >= CASE WHEN hexa THEN 3.0 ELSE 3.8 END - 1e-12
), grouped AS (
    SELECT *, sum(CAST(fresh AS INTEGER)) OVER (PARTITION BY r ORDER BY a) AS part
    FROM (SELECT *, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a) < a, TRUE) AS fresh FROM hot)
), merged AS (
    SELECT r, 3 AS ord, 'entropy' AS kind, min(a) AS start, max(b) AS stop FROM grouped GROUP BY r, part
), added AS (
    SELECT * FROM merged m WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.r = m.r AND b.start < m.stop AND m.start < b.stop)
), every AS (
    SELECT * FROM base UNION ALL SELECT * FROM added
), joined AS (
    SELECT r, count(*) FILTER (ord = 0) AS n_assign, count(*) FILTER (ord = 1) AS n_access, count(*) FILTER (ord = 2) AS n_hex,
           count(*) FILTER (ord = 3) AS n_entropy,
           string_agg(kind || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT), ',' ORDER BY start, ord) FILTER (ord < 3) AS base,
           string_agg(kind || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT), ',' ORDER BY start, ord) AS spans
    FROM every GROUP BY r
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       coalesce(n_entropy, 0) AS n_entropy, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM doc LEFT JOIN joined USING (r)
"""

_LINES = r"""
WITH doc AS (
    SELECT doc_id, row_number() OVER () AS r, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), keyed AS (
    SELECT r, doc_id, pos, line,
           translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM (SELECT r, doc_id, unnest(generate_series(1, len(lines))) AS pos, unnest(lines) AS line FROM doc)
), repeated AS (
    SELECT key, max(doc_id) AS keeper FROM (SELECT DISTINCT key, doc_id FROM keyed WHERE length(key) >= 40)
    GROUP BY key HAVING count(*) >= 5
), judged AS (
    SELECT k.r, k.doc_id, k.pos, k.line, p.keeper IS NOT NULL AND (k.doc_id IS NULL OR k.doc_id < p.keeper) AS drops
    FROM keyed k LEFT JOIN repeated p ON k.key = p.key
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (drops) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT drops), '')) AS kept_sha256
FROM judged GROUP BY r
"""

_NEAR = r"""
WITH RECURSIVE doc AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, words FROM (
        SELECT doc_id, unnest(list_transform(generate_series(1, greatest(1, len(w) - 1)), lambda pos: array_to_string(w[pos:pos + 1], ' '))) AS words
        FROM doc WHERE len(w) > 0)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
    FROM shingles a JOIN shingles b ON a.words = b.words AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
    SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * common >= 80 * (x.n + y.n - common)
), ways AS (
    SELECT a, b FROM links UNION SELECT b, a FROM links
), reach AS (
    SELECT a AS doc_id, a AS other FROM ways
    UNION SELECT r.doc_id, w.b FROM reach r JOIN ways w ON w.a = r.other
), smallest AS (
    SELECT doc_id, min(other) AS label FROM reach GROUP BY doc_id
)
SELECT doc.doc_id, coalesce(n, 0) AS n_shingles, coalesce(label, doc.doc_id) AS component_id, coalesce(label, doc.doc_id) = doc.doc_id AS kept
FROM doc LEFT JOIN sizes USING (doc_id) LEFT JOIN smallest USING (doc_id)
"""

#: Levels that are enough for 8^9 leaves and as many langs as 8^3; a group that is one node already stays as it is.
_LEAF_LEVELS, _LANG_LEVELS = 9, 3


def _merkle_level(number: int, nodes: str, groups: str, above: str) -> str:
    """One level: every run's digest, and each node's siblings; groups of one node are passed on."""
    return f"""
{above}{number}_runs AS (
    SELECT {groups}, place // 8 AS place, sha256(string_agg(digest, '' ORDER BY place)) AS digest,
           list(digest ORDER BY place) AS run FROM {nodes} GROUP BY ALL
), {above}{number}_many AS (
    SELECT {groups}, count(*) > 1 AS many FROM {nodes} GROUP BY ALL
), {above}{number} AS (
    SELECT {groups}, r.place, CASE WHEN many THEN r.digest ELSE run[1] END AS digest, many, run
    FROM {above}{number}_runs r JOIN {above}{number}_many m USING ({groups})
)"""


def _merkle() -> str:
    levels, nodes = [], "leaves"
    for number in range(1, _LEAF_LEVELS + 1):
        levels.append(_merkle_level(number, nodes, "part", "n"))
        nodes = f"n{number}"
    tops, nodes = [], "subroots"
    for number in range(1, _LANG_LEVELS + 1):
        tops.append(_merkle_level(number, nodes, "whole", "t"))
        nodes = f"t{number}"
    # A leaf's way up: its place on a level is its place divided by 8 per level.
    joins, siblings, folds = [], [], []
    for names, count, own, key in (("n", _LEAF_LEVELS, "l.place", "part"), ("t", _LANG_LEVELS, "s.place", "whole")):
        for number in range(1, count + 1):
            name, below = f"{names}{number}", f"({own} // {8 ** (number - 1)}) % 8"
            on = f"{name}.part = l.part" if key == "part" else f"{name}.whole = s.whole"
            joins.append(f"JOIN {name} ON {on} AND {name}.place = {own} // {8 ** number}")
            others = f"list_slice({name}.run, 1, {below}), list_slice({name}.run, {below} + 2, 8)"
            siblings.append(f"CASE WHEN {name}.many THEN array_to_string(list_concat({others}), '') ELSE '' END")
            # A node's fold: the run with this node put in its place.
            folds.append((name, f"list_slice({name}.run, 1, {below})", f"list_slice({name}.run, {below} + 2, 8)"))
    steps, before = [], "changed AS f0"
    for number, (name, left, right) in enumerate(folds, start=1):
        steps.append(
            f"f{number} AS (SELECT * EXCLUDE (f{number - 1}, {name}_left, {name}_right, {name}_many), CASE WHEN {name}_many THEN "
            f"sha256(array_to_string({name}_left, '') || f{number - 1} || array_to_string({name}_right, '')) ELSE f{number - 1} END AS f{number} "
            f"FROM {'ways' if number == 1 else f'f{number - 1}'})"
        )
    carried = ", ".join(f"{left} AS {name}_left, {right} AS {name}_right, {name}.many AS {name}_many" for name, left, right in folds)
    cells = ["doc_id", "source", "lang", "n_chars"]
    cell = {name: f"coalesce(strlen(CAST({name} AS VARCHAR)) || ':' || {name}, '-')" for name in cells}
    text = "coalesce(strlen({0}) || ':' || {0}, '-')"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    bits = "crc"
    for _ in range(8):
        bits = f"list_transform([{bits}], lambda c: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)[1]"
    crc = (
        "xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), "
        f"lambda d: CAST(ascii(d) AS BIGINT))), lambda state, byte: {bits.replace('crc', 'xor(state, byte)')}), 4294967295)"
    )
    head = " || ".join(cell.values())
    return f"""
WITH digests AS (
    SELECT doc_id, coalesce('=' || lang, '') AS part, sha256({head} || {text.format('text')}) AS leaf,
           CASE WHEN coalesce({crc} % 3 = 0, false) THEN sha256({head} || {text.format(lower)}) END AS tampered
    FROM documents
), leaves AS (
    SELECT doc_id, part, leaf AS digest, coalesce(tampered, leaf) AS changed,
           row_number() OVER (PARTITION BY part ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM digests
), {', '.join(levels)}, subroots AS (
    SELECT 0 AS whole, part, digest, row_number() OVER (ORDER BY encode(part)) - 1 AS place FROM n{_LEAF_LEVELS}
), {', '.join(tops)}, ways AS (
    SELECT l.doc_id, l.digest AS leaf, s.digest AS subroot, (SELECT digest FROM t{_LANG_LEVELS}) AS root,
           sha256({' || '.join(siblings)}) AS proof_sha256, {carried}, l.{before}
    FROM leaves l JOIN subroots s ON s.part = l.part {' '.join(joins)}
), {', '.join(steps)}
SELECT doc_id, leaf, subroot, root, proof_sha256, f{len(folds)} AS folded_root, f{len(folds)} = root AS verified FROM f{len(folds)}
"""


ORACLES: dict[str, str] = {
    "op1_nearest_vectors": _NEAREST,
    "op2_chat_windows": _CHAT,
    "op3_contamination": _CONTAMINATION,
    "op6_mix": _MIX,
    "op7_secrets": _SECRETS,
    "op8_repeated_lines": _LINES,
    "op10_near_duplicates": _NEAR,
    "op12_manifest": _merkle(),
}
