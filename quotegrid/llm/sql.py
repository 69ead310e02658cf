"""SQL counterparts of the registered queries, for DuckDB.

Written from the operators' definitions, not from their plans: words by a regular expression,
windows by list positions, sketches by plain grouping.
"""

from __future__ import annotations

from quotegrid.llm import lines, mixing, quality, substrings

WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"


def _fences(table: str, group: str) -> str:
    by = f"{group}, " if group else ""
    return f"""
      SELECT {by}measure, max(upto) AS size, any_value(least) AS least,
             min(value) FILTER (10 * upto >= total) AS low,
             min(value) FILTER (10 * upto >= 5 * total) AS middle,
             min(value) FILTER (10 * upto >= 9 * total) AS high,
             high + {quality.REACH} * greatest(high - middle, any_value(least)) AS upper,
             low - {quality.REACH} * greatest(middle - low, any_value(least)) AS lower
      FROM (SELECT *, sum(n) OVER (PARTITION BY {by}measure ORDER BY value) AS upto,
                   sum(n) OVER (PARTITION BY {by}measure) AS total
            FROM (SELECT {by}measure, value, any_value(least) AS least, sum(n) AS n FROM {table}
                  GROUP BY {by}measure, value))
      GROUP BY {by}measure"""


def _blend(own: str, parent: str, end: str, parent_end: str | None = None) -> str:
    n, prior = f"{own}.size", quality.PRIOR
    above = parent_end or f"{parent}.{end}"
    total = f"({n} * {own}.{end} + {prior} * {above})"
    return f"CAST(floor(CAST({total} AS DOUBLE) / ({n} + {prior})) AS BIGINT)"


def _op9() -> str:
    entries = " UNION ALL ".join(
        f"SELECT rid, lang, source, '{name}' AS measure, CAST({text.replace(' div ', ' // ')} AS BIGINT)"
        f" AS value, {least} AS least, {both} AS both_ends FROM base WHERE NOT base_failed"
        for name, (text, least, both) in quality.MEASURES.items()
    )
    symbols = quality.SYMBOLS
    bits = quality.SKETCH_BITS
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS text,
                  {WORDS} AS w,
                  list_filter(string_split(coalesce(text, ''), chr(10)),
                              lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l
           FROM documents),
wins AS (SELECT rid, i, list_slice(w, i, i + 2) AS g
         FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM wins)
          WHERE c >= 2),
rep AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM twice)
        GROUP BY rid),
counts AS (SELECT d.rid, doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words,
                CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
                CAST(length(text) - length(translate(text, '{symbols}', '')) AS BIGINT) AS n_symbols,
                CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
                CAST(len(l) AS BIGINT) AS n_lines,
                CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
         FROM d LEFT JOIN rep ON d.rid = rep.rid),
base AS (SELECT *, n_words < {quality.MIN_WORDS}
                   OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed
         FROM counts),
entries AS ({entries}),
sketch AS (SELECT lang, source, measure,
                  value - value % CAST(pow(2, greatest(length(bin(value)) - {bits}, 0)) AS BIGINT) AS value,
                  least, count(*) AS n
           FROM entries GROUP BY ALL),
own AS ({_fences("sketch", "lang, source")}),
language AS ({_fences("sketch", "lang")}),
corpus AS ({_fences("sketch", "")}),
above AS (SELECT l.lang, l.measure, {_blend("l", "c", "upper")} AS upper,
                 {_blend("l", "c", "lower")} AS lower
          FROM language l JOIN corpus c ON l.measure = c.measure),
limits AS (SELECT o.lang, o.source, o.measure, o.size, {_blend("o", "a", "upper")} AS upper,
                  {_blend("o", "a", "lower")} AS lower
           FROM own o JOIN above a ON o.lang IS NOT DISTINCT FROM a.lang AND o.measure = a.measure),
verdict AS (SELECT rid, bool_and(value <= upper AND (NOT both_ends OR value >= lower)) AS ok
            FROM entries e JOIN limits m
              ON e.lang IS NOT DISTINCT FROM m.lang AND e.source IS NOT DISTINCT FROM m.source
                 AND e.measure = m.measure
            GROUP BY rid),
shares AS (SELECT DISTINCT lang, source,
                  CAST(floor(CAST(1000 * size AS DOUBLE) / (size + {quality.PRIOR})) AS BIGINT) AS own_share
           FROM limits)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       own_share, NOT base_failed AND coalesce(ok, false) AS kept
FROM base LEFT JOIN verdict ON base.rid = verdict.rid
LEFT JOIN shares ON base.lang IS NOT DISTINCT FROM shares.lang
                    AND base.source IS NOT DISTINCT FROM shares.source
"""


def _op5() -> str:
    weights = f"list_extract([{', '.join(map(str, mixing.WEIGHTS))}], CAST((rank - 1) % 3 + 1 AS INT))"
    return f"""
WITH d AS (SELECT doc_id, coalesce('1' || source, '0') AS queue, CAST(len({WORDS}) AS BIGINT) AS size,
                  md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':'
                      || md5(coalesce(text, '')) || ':'
                      || row_number() OVER (PARTITION BY doc_id, coalesce(text, '')) - 1) AS place
           FROM documents),
totals AS (SELECT queue, CAST(sum(size) AS BIGINT) AS source_size,
                  row_number() OVER (ORDER BY queue = '0', queue) AS rank FROM d GROUP BY queue),
weighed AS (SELECT *, {weights} AS weight, {mixing.MAX_PASSES} * source_size AS cap,
                   sum(source_size) OVER () * {mixing.BUDGET_SHARE}::DOUBLE AS budget FROM totals),
levels AS (SELECT *, (budget - coalesce(sum(cap) OVER (ORDER BY cap / weight, rank
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                     / sum(weight) OVER (ORDER BY cap / weight, rank
                          ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighed),
goals AS (SELECT *, CASE WHEN cap <= weight * level THEN CAST(cap AS DOUBLE)
                    ELSE weight * min_by(level, cap / weight) FILTER (cap > weight * level) OVER () END AS target
          FROM levels),
passes AS (SELECT doc_id, size, source_size, target, rank, budget,
                  (pass * source_size + sum(size) OVER (PARTITION BY pass, g.queue ORDER BY place, doc_id
                                                        ROWS UNBOUNDED PRECEDING)) / weight AS finish
           FROM d JOIN goals g ON d.queue = g.queue, (VALUES (0), (1)) p(pass)),
cut AS (SELECT *, sum(size) OVER (ORDER BY finish, rank) <= budget AS within FROM passes)
SELECT doc_id, size, source_size, target, CAST(count(*) FILTER (within) AS INT) AS passes,
       CAST(size * count(*) FILTER (within) AS BIGINT) AS taken
FROM cut GROUP BY doc_id, size, source_size, target
"""


def _op11() -> str:
    bits = "array_to_string(list_transform(string_split(digest, ''), lambda x: list_extract(" + (
        "[" + ", ".join(f"'{n:04b}'" for n in range(16)) + "], instr('0123456789abcdef', x))), '')"
    )
    value = " + ".join(f"{16 >> k} * CAST(bits[5 * i + {k + 1}] AS INT)" for k in range(5))
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    base32 = (
        "array_to_string(list_transform(range(32), "
        f"lambda i: substr('{letters}', CAST({value} + 1 AS INT), 1)), '')"
    )
    return f"""
WITH p AS (SELECT page_id, url, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes,
                  sha1(coalesce(html, '')) AS digest FROM pages),
b AS (SELECT *, {bits} AS bits,
             row_number() OVER (PARTITION BY digest, payload_bytes
                                ORDER BY page_id DESC NULLS LAST, url DESC NULLS LAST) AS place,
             max(page_id) OVER (PARTITION BY digest, payload_bytes) AS top FROM p)
SELECT page_id, payload_bytes, {base32} AS payload_digest,
       CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN place > 1 THEN top END AS refers_to
FROM b
"""


def _crc32(text: str) -> str:
    """The CRC-32 of an ASCII text, bit by bit."""
    bit = "CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END"
    byte = f"list_reduce([xor(c, b)] || range(8), lambda x, i: {bit})"
    data = f"list_transform(string_split({text}, ''), lambda x: CAST(ascii(x) AS BIGINT))"
    return f"xor(list_reduce([4294967295] || {data}, lambda c, b: {byte}), 4294967295)"


def _op12() -> str:
    """The costs and edits of the rows still to come are one text per state, '000012DIK'."""
    plus = lambda x, cost, letter: (
        f"(lpad(CAST(CAST(substr({x}, 1, 6) AS INT) + {cost} AS VARCHAR), 6, '0') || '{letter}'"
        f" || substr({x}, 7))"
    )
    far = "'900000'"
    follow = [2, 2, 3, 2]  # the state after the turn that a state asks for

    def closed(states: list[str], names: str) -> str:
        """Insertions, tried three times over, as nested single-row tables."""
        inner = ", ".join(f"{x} AS {names}{s}" for s, x in enumerate(states))
        query = f"SELECT {inner}"
        for _ in range(3):
            some = [f"least({names}{s}, {plus(f'{names}{follow[s]}', 5, 'I')}) AS {names}{s}" for s in range(4)]
            query = f"SELECT {', '.join(some)} FROM ({query})"
        return query

    def row(state: int) -> str:
        gone = plus(f"a{state}", 2, "D")
        wanted = "a" if state == 2 else "u"
        stay = f"CASE WHEN first = '{wanted}' THEN {{k}} ELSE {{r}} END".format(
            k=f"CASE WHEN cut THEN {plus(f'a{follow[state]}', 5, 'K')} ELSE {plus(f'a{follow[state]}', 0, 'K')} END",
            r=f"CASE WHEN cut THEN {plus(f'a{follow[state]}', 6, 'R')} ELSE {plus(f'a{follow[state]}', 1, 'R')} END",
        )
        if state == 0:
            system = f"CASE WHEN cut THEN {plus('a1', 5, 'K')} ELSE {plus('a1', 0, 'K')} END"
            stay = f"least({stay}, CASE WHEN first = 's' THEN {system} ELSE {far} END)"
        return f"CASE WHEN gone THEN {gone} ELSE least({gone}, {stay}) END"

    end = closed(["'000000'", far, far, "'000000'"], "a")
    # One step back over a row, then insertions in front of it.
    step = f"SELECT conv, pos, {', '.join(f'{row(s)} AS a{s}' for s in range(4))} FROM before"
    for _ in range(3):
        some = [f"least(a{s}, {plus(f'a{follow[s]}', 5, 'I')}) AS a{s}" for s in range(4)]
        step = f"SELECT conv, pos, {', '.join(some)} FROM ({step})"
    return f"""
WITH RECURSIVE ids AS (SELECT DISTINCT conv_id AS conv FROM conversations),
raw AS (SELECT conv_id AS conv, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               {_crc32("(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS hit
        FROM conversations),
damaged AS (SELECT conv, turn, CASE WHEN hit = 4 THEN 'user' ELSE role END AS role,
                   CASE hit WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
                   unnest(range(CASE WHEN hit = 3 THEN 2 ELSE 1 END)) AS copy
            FROM raw WHERE hit <> 0),
ordered AS (SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text) AS pos,
                   regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS bare FROM damaged),
marked AS (SELECT *, left(role, 1) AS first, bare = '' AS blank,
                  row_number() OVER (PARTITION BY conv, role, text ORDER BY pos) > 1 AS again,
                  NOT regexp_matches(bare, '[.!?]$') AS cut,
                  lag(left(role, 1)) OVER (PARTITION BY conv ORDER BY pos) AS prior,
                  count(*) OVER (PARTITION BY conv) AS n FROM ordered),
codes AS (SELECT *, blank OR again AS gone FROM marked),
steps AS (SELECT ids.conv, coalesce(max(c.n), 0) AS pos, e.* FROM ids
          LEFT JOIN codes c ON c.conv IS NOT DISTINCT FROM ids.conv, ({end}) e
          GROUP BY ALL),
walk AS (SELECT conv, pos, a0, a1, a2, a3 FROM steps
         UNION ALL
         SELECT * FROM (WITH before AS (SELECT w.conv, w.pos - 1 AS pos, a0, a1, a2, a3, first, gone, cut
                                        FROM walk w JOIN codes c ON c.conv IS NOT DISTINCT FROM w.conv
                                                                AND c.pos = w.pos)
                        {step})),
best AS (SELECT conv, CAST(substr(a0, 1, 6) AS BIGINT) AS cost, substr(a0, 7) AS audit
         FROM walk WHERE pos = 0),
letters AS (SELECT conv, unnest(string_split(audit, '')) AS letter, unnest(range(length(audit))) AS i
            FROM best WHERE audit <> ''),
placed AS (SELECT *, count(*) FILTER (letter <> 'I') OVER (PARTITION BY conv ORDER BY i) AS pos
           FROM letters),
stays AS (SELECT p.conv, p.i, letter, CASE WHEN letter = 'I' THEN '' ELSE text END AS text, role,
                 row_number() OVER (PARTITION BY p.conv ORDER BY i) AS k
          FROM placed p LEFT JOIN codes c ON c.conv IS NOT DISTINCT FROM p.conv AND c.pos = p.pos
          WHERE letter <> 'D'),
system AS (SELECT conv FROM stays WHERE k = 1 AND letter = 'K' AND left(role, 1) = 's'),
spoken AS (SELECT s.*, CASE WHEN letter = 'K' THEN role
                            WHEN (k + CASE WHEN m.found THEN 1 ELSE 0 END) % 2 = 1 THEN 'user'
                            ELSE 'assistant' END AS said
           FROM stays s LEFT JOIN (SELECT conv, true AS found FROM system) m
                        ON m.conv IS NOT DISTINCT FROM s.conv),
joined AS (SELECT conv, string_agg(said || ':' || text, chr(10) ORDER BY i) AS whole
           FROM spoken GROUP BY conv),
counts AS (SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                  count(*) FILTER (blank) AS blank, count(*) FILTER (NOT blank AND again) AS duplicate,
                  count(*) FILTER (NOT blank AND NOT again AND cut) AS truncated,
                  count(*) FILTER (pos > 1 AND prior || first NOT IN ('su', 'ua', 'au')) AS illegal
           FROM codes GROUP BY conv)
SELECT best.conv AS conv_id,
       {', '.join(f'CAST(coalesce({c}, 0) AS BIGINT) AS {c}' for c in ('gaps', 'blank', 'duplicate', 'truncated', 'illegal'))},
       cost, audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM best LEFT JOIN counts ON counts.conv IS NOT DISTINCT FROM best.conv
LEFT JOIN joined ON joined.conv IS NOT DISTINCT FROM best.conv
"""


def _op13() -> str:
    head = f"({_crc32('CAST(conv_id AS VARCHAR)')} % 4)"
    words = WORDS.replace("coalesce(text, '')", "p[d].t")
    return f"""
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                      coalesce(role, ''), coalesce(text, '')) AS pos,
                  {{'r': coalesce(role, ''), 't': coalesce(text, '')}} AS said
           FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list(said ORDER BY pos) AS l FROM t GROUP BY conv_id),
heads AS (SELECT conv_id, l, conv_id - conv_id % 20 AS base, CAST({head} AS BIGINT) AS h FROM own),
seqs AS (SELECT c.conv_id, list_concat(coalesce(b.l[1:c.h], []), c.l[c.h + 1:]) AS seq
         FROM heads c LEFT JOIN own b ON b.conv_id = c.base),
prefixes AS (SELECT conv_id, len(seq) AS n, unnest(range(len(seq) + 1)) AS d, seq FROM seqs),
nodes AS (SELECT d, seq[1:d] AS p, min(conv_id) AS conv_id, count(*) AS n_convs,
                 coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = d), '') AS ends
          FROM prefixes GROUP BY 1, 2),
kids AS (SELECT d - 1 AS d, p[1:d - 1] AS p, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1, 2),
full_nodes AS (SELECT nodes.*, coalesce(kids.n, 0) AS n_children,
                      CASE WHEN nodes.d = 0 THEN 0 ELSE (n_convs - 1) * len({words.replace('p[d]', 'nodes.p[nodes.d]')}) END AS own
               FROM nodes LEFT JOIN kids ON kids.d = nodes.d AND kids.p = nodes.p),
below AS (SELECT a AS d, p[1:a] AS p, count(*) FILTER (n_children = 0) AS n_leaves, sum(own) AS saved
          FROM (SELECT *, unnest(range(d + 1)) AS a FROM full_nodes) GROUP BY 1, 2)
SELECT f.conv_id, CAST(f.d AS BIGINT) AS depth, up.conv_id AS parent_conv_id, f.n_convs,
       CAST(f.n_children AS BIGINT) AS n_children, below.n_leaves,
       CAST(below.saved AS BIGINT) AS saved_tokens, sha256(f.ends) AS ends_sha256
FROM full_nodes f JOIN below ON below.d = f.d AND below.p = f.p
LEFT JOIN nodes up ON up.d = f.d - 1 AND up.p = f.p[1:f.d - 1]
"""


def _op3(k: int = 4) -> str:
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    words = WORDS.replace("coalesce(text, '')", lower)
    return f"""
WITH RECURSIVE w AS (SELECT doc_id, {words} AS w FROM documents),
grams AS (SELECT DISTINCT doc_id, list_slice(w, i, i + least({k}, len(w)) - 1) AS g
          FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {k} + 2, 2))) AS i FROM w WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
numbered AS (SELECT doc_id, dense_rank() OVER (ORDER BY g) AS g FROM grams),
shared AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS s
           FROM numbered a JOIN numbered b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT u, v FROM shared JOIN sizes p ON p.doc_id = u JOIN sizes q ON q.doc_id = v
          WHERE 100 * s >= 80 * (p.n + q.n - s)),
edges AS (SELECT u, v FROM links UNION SELECT v, u FROM links),
reach AS (SELECT doc_id AS node, doc_id AS least FROM documents
          UNION SELECT e.v, r.least FROM reach r JOIN edges e ON e.u = r.node WHERE r.least < e.v)
SELECT d.doc_id, coalesce(sizes.n, 0) AS n_shingles, min(least) AS component_id,
       d.doc_id = min(least) AS kept
FROM documents d JOIN reach ON reach.node = d.doc_id LEFT JOIN sizes ON sizes.doc_id = d.doc_id
GROUP BY d.doc_id, sizes.n
"""


def _op8() -> str:
    blanks = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    need = lines.BLOCK_WORDS
    return f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, i, line, trim(line, {blanks}) AS key,
             len(list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda w: w <> '')) AS n
      FROM (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS i FROM d)),
docs AS (SELECT doc_id, list(key ORDER BY i) AS keys, count(*) AS n_lines, sum(n) AS n_words
         FROM l GROUP BY doc_id),
classes AS (SELECT doc_id, n_lines, n_words > 0 AND row_number() OVER (PARTITION BY keys ORDER BY doc_id) > 1 AS copy
            FROM docs),
upto AS (SELECT doc_id, i, sum(n) OVER (PARTITION BY doc_id ORDER BY i) AS upto, n FROM l),
own AS (SELECT u.* FROM upto u JOIN classes c ON c.doc_id = u.doc_id WHERE NOT copy),
spans AS (SELECT a.doc_id, a.i, min(b.i) AS j FROM own a JOIN own b
            ON a.doc_id = b.doc_id AND b.i >= a.i AND b.upto - a.upto + a.n >= {need} GROUP BY 1, 2
          UNION
          SELECT b.doc_id, max(a.i), b.i FROM own a JOIN own b
            ON a.doc_id = b.doc_id AND b.i >= a.i AND b.upto - a.upto + a.n >= {need} GROUP BY 1, 3),
texts AS (SELECT s.doc_id, s.i, s.j, list_slice(keys, s.i + 1, s.j + 1) AS run
          FROM spans s JOIN docs ON docs.doc_id = s.doc_id),
firsts AS (SELECT run, min(doc_id) AS first FROM texts GROUP BY run),
gone AS (SELECT DISTINCT t.doc_id, unnest(range(t.i, t.j + 1)) AS i
         FROM texts t JOIN firsts f ON f.run = t.run AND f.first < t.doc_id),
rest AS (SELECT l.doc_id, count(gone.i) AS n, string_agg(line, chr(10) ORDER BY l.i) FILTER (gone.i IS NULL) AS kept
         FROM l LEFT JOIN gone ON gone.doc_id = l.doc_id AND gone.i = l.i GROUP BY l.doc_id)
SELECT c.doc_id, c.n_lines, CASE WHEN copy THEN c.n_lines ELSE rest.n END AS n_removed,
       sha256(CASE WHEN copy THEN '' ELSE coalesce(kept, '') END) AS kept_sha256
FROM classes c JOIN rest ON rest.doc_id = c.doc_id
"""


def _op10() -> str:
    k = substrings.WINDOW
    return f"""
WITH w AS (SELECT doc_id, {WORDS} AS w FROM documents),
wins AS (SELECT doc_id, i, array_to_string(list_slice(w, i, i + {k - 1}), ' ') AS g
         FROM (SELECT doc_id, w, unnest(range(1, len(w) - {k - 2})) AS i FROM w WHERE len(w) >= {k})),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY g) AS c FROM wins) WHERE c > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + {k})) AS i FROM twice),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM w),
rest AS (SELECT words.doc_id, count(gone.i) AS n,
                string_agg(word, ' ' ORDER BY words.i) FILTER (gone.i IS NULL) AS kept
         FROM words LEFT JOIN gone ON gone.doc_id = words.doc_id AND gone.i = words.i
         GROUP BY words.doc_id)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, coalesce(rest.n, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN rest ON rest.doc_id = w.doc_id
"""


LLM_ORACLE_SQL = {
    "op3_minhash_near_dedup": _op3(),
    "op5_weighted_mix": _op5(),
    "op8_line_dedup": _op8(),
    "op9_quality_rules": _op9(),
    "op10_substring_dedup": _op10(),
    "op11_warc": _op11(),
    "op12_conversation_repair": _op12(),
    "op13_prefix_trie": _op13(),
}
