"""DuckDB SQL for the results of operators 12 and 13, built from their rules."""

from __future__ import annotations

from reelmetry.llm import turn_repair


def _crc_table() -> list[int]:
    """The crc32 of single bytes, by its polynomial."""
    table = []
    for value in range(256):
        for _ in range(8):
            value = (value >> 1) ^ (0xEDB88320 if value & 1 else 0)
        table.append(value)
    return table


def crc32(text: str) -> str:
    """The unsigned crc32 of a text's UTF-8 bytes, as an expression over ``crc`` (a relation with the list ``step``)."""
    taken = f"list_transform(range(0, strlen({text})), lambda i: CAST('0x' || substr(hex({text}), CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295, {taken}), lambda c, b: xor(c >> 8, crc.step[CAST((xor(c, b) & 255) + 1 AS BIGINT)])), 4294967295)"


CRC = f"crc AS (SELECT CAST({_crc_table()} AS BIGINT[]) AS step)"


def turn_repair_sql() -> str:
    """Every edit of a turn from every state is a row of ``moves``; the recursion keeps the least cost and audit per state."""
    moves = []
    for begin in range(4):
        state, inserted = begin, []
        for inserts in range(3):
            before = "[" + ", ".join(f"'{r}:'" for r in inserted) + "]::VARCHAR[]"
            head, cost = "I" * inserts, turn_repair.INSERT * inserts
            on = 3 if state == 2 else 2
            moves.append((begin, "D", f"'{head}D'", state, cost + turn_repair.DELETE, before, "''"))
            moves.append((begin, "R", f"'{head}R'", on, cost + turn_repair.REROLE, before, "'assistant'" if on == 3 else "'user'"))
            for initial, q in {0: (("s", 1), ("u", 2)), 1: (("u", 2),), 2: (("a", 3),), 3: (("u", 2),)}[state]:
                moves.append((begin, initial, f"'{head}K'", q, cost, before, "''"))
            inserted = [*inserted, "assistant" if on == 3 else "user"]
            state = on
    values = ",\n    ".join(f"({p}, '{kind}', {letters}, {q}, {cost}, {before}, {role})" for p, kind, letters, q, cost, before, role in moves)
    crc = crc32("key")
    return f"""WITH RECURSIVE {CRC},
keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
kinds AS (SELECT keyed.*, {crc} % 20 AS kind FROM keyed, crc),
hurt AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
  CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM kinds),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS pos FROM hurt),
matched AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) AS nth, lead(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS next_initial,
  regexp_replace(text, '[ \\x09-\\x0D]+$', '') AS written FROM placed),
faults AS (SELECT *, CASE WHEN written = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN right(written, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM matched),
facts AS (SELECT conv_id, CAST(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
  count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
  count(*) FILTER (next_initial IS NOT NULL AND left(role, 1) || next_initial NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n_rows FROM faults GROUP BY conv_id),
listed AS (SELECT DISTINCT conv_id FROM conversations),
moves(p, kind, letters, q, cost, before, role) AS (VALUES
    {values}),
paths AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS pos, 0 AS state, {{'cost': CAST(0 AS BIGINT), 'audit': '', 'lines': []::VARCHAR[]}} AS best FROM listed
  UNION ALL
  SELECT p.conv_id, p.pos + 1, m.q, min({{'cost': p.best.cost + m.cost + CASE WHEN m.kind <> 'D' AND f.fault = 'truncated' THEN {turn_repair.CUT_OFF} ELSE 0 END,
    'audit': p.best.audit || m.letters, 'lines': p.best.lines || m.before || CASE m.kind WHEN 'D' THEN []::VARCHAR[] WHEN 'R' THEN [m.role || ':' || f.text] ELSE [f.role || ':' || f.text] END}})
  FROM paths p JOIN faults f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.pos = p.pos + 1
    JOIN moves m ON m.p = p.state AND (m.kind = 'D' OR (f.fault NOT IN ('blank', 'duplicate') AND m.kind IN ('R', left(f.role, 1))))
  GROUP BY p.conv_id, p.pos, m.q),
ends AS (SELECT p.conv_id, min({{'cost': p.best.cost + CASE p.state WHEN 1 THEN 4 WHEN 2 THEN 2 ELSE 0 END, 'audit': p.best.audit || CASE p.state WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END,
    'lines': p.best.lines || CASE p.state WHEN 1 THEN ['user:', 'assistant:'] WHEN 2 THEN ['assistant:'] ELSE []::VARCHAR[] END}}) AS best
  FROM paths p LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM p.conv_id WHERE p.pos = coalesce(f.n_rows, 0) GROUP BY p.conv_id)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  CAST(e.best.cost AS BIGINT) AS cost, e.best.audit AS audit, sha256(coalesce(array_to_string(e.best.lines, chr(10)), '')) AS repaired_sha256
FROM ends e LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM e.conv_id"""


def word_variants_sql() -> str:
    """Near words by their deletions: two words that are equal without the same place, or one that is the other without a place."""
    capitals, small = "".join(map(chr, range(65, 91))), "".join(map(chr, range(97, 123)))
    crc = crc32("key")
    return f"""WITH RECURSIVE {CRC},
runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\\x{{00C0}}-\\x{{00FF}}]+')), '{capitals}', '{small}') AS run FROM documents),
counted AS (SELECT doc_id, run, count(*) AS n, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS key FROM runs WHERE length(run) >= 6 GROUP BY doc_id, run),
hashed AS (SELECT run, n, {crc} AS h FROM counted, crc),
cut AS (SELECT CASE WHEN h % 199 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM cut WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
places AS (SELECT word, unnest(range(length(word))) AS pos FROM words),
without AS (SELECT word, pos, left(word, pos) || substr(word, pos + 2) AS rest FROM places),
pairs AS (
  SELECT a.word, b.word AS other FROM without a JOIN without b ON a.rest = b.rest AND a.pos = b.pos AND a.word <> b.word
  UNION SELECT a.word, b.word FROM without a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word FROM without a JOIN words b ON a.rest = b.word),
ranked AS (SELECT p.word, p.other, o.n, count(*) OVER (PARTITION BY p.word) AS n_near, row_number() OVER (PARTITION BY p.word ORDER BY o.n DESC, p.other) AS place
  FROM pairs p JOIN words o ON o.word = p.other),
linked AS (SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN r.n >= 5 * w.n THEN r.other END AS form, CASE WHEN r.n >= 5 * w.n THEN r.n END AS form_n
  FROM words w LEFT JOIN ranked r ON r.word = w.word AND r.place = 1),
walks AS (SELECT word, word AS root, form AS further FROM linked
  UNION ALL SELECT w.word, l.word, l.form FROM walks w JOIN linked l ON l.word = w.further)
SELECT l.word, l.form, w.root, l.n, l.n_near, l.form_n FROM linked l JOIN walks w ON w.word = l.word AND w.further IS NULL"""
