"""The same results in DuckDB SQL where it can express an operator, written from the queries' definitions alone.

They compare every string with every equal string, or fold rows one by one, so they are meant for small tables.
"""

# The CRC-32 of the strings `s` of a table `keyed`, byte by byte from a table of 256 remainders; its polynomial is a fixed value.
_CRC = """remainders(b, c, k) AS (
  SELECT b, b, 0 FROM range(256) r(b)
  UNION ALL
  SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM remainders WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY b) AS t FROM remainders WHERE k = 8),
crc_of AS (
  SELECT s, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(octet_length(encode(s))), lambda i: ('0x' || substr(hex(encode(s)), 2 * i + 1, 2))::BIGINT)),
    lambda c, byte: xor(t[(xor(c, byte) & 255) + 1], c >> 8)), 4294967295::BIGINT) AS crc
  FROM (SELECT DISTINCT s FROM keyed), crc_table)"""

REPEATS = """
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, 9223372036854775807) AS place,
         hex(encode(coalesce(text, ''))) AS h
  FROM documents),
windows AS (
  SELECT r, place, i, substr(h, 2 * i + 1, 100) AS w
  FROM (SELECT r, place, h, unnest(range(0, length(h) // 2 - 49)) AS i FROM texts)),
earliest AS (SELECT w, min(place) AS place FROM windows GROUP BY w),
starts AS (SELECT a.r, a.i FROM windows a JOIN earliest e ON a.w = e.w WHERE e.place < a.place),
opened AS (
  SELECT r, i, CASE WHEN i <= lag(i) OVER (PARTITION BY r ORDER BY i) + 50 THEN 0 ELSE 1 END AS opens FROM starts),
numbered AS (
  SELECT r, i, sum(opens) OVER (PARTITION BY r ORDER BY i) AS run FROM opened),
runs AS (SELECT r, min(i) AS a, max(i) + 50 AS b FROM numbered GROUP BY r, run),
borders AS (SELECT r, a, b, lag(b, 1, 0) OVER (PARTITION BY r ORDER BY a) AS before FROM runs),
cut AS (
  SELECT t.r, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS tail,
         string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept
  FROM borders JOIN texts t ON t.r = borders.r GROUP BY t.r)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(tail, 0) + 1))) AS kept_sha256
FROM texts LEFT JOIN cut ON texts.r = cut.r
"""

NEAR_DUPLICATES = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c >= 85 * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (
  SELECT a AS doc_id, b AS other FROM both_ways
  UNION
  SELECT reached.doc_id, b FROM reached JOIN both_ways ON a = other),
least AS (SELECT doc_id, min(other) AS other FROM reached GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(other, d.doc_id)) AS component_id,
       coalesce(d.doc_id = least(d.doc_id, coalesce(other, d.doc_id)), true) AS kept
FROM documents d LEFT JOIN sizes ON sizes.doc_id = d.doc_id LEFT JOIN least ON least.doc_id = d.doc_id
"""

SPELLING = f"""
WITH RECURSIVE runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS d, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run
    FROM documents) WHERE length(run) >= 6 GROUP BY ALL),
keyed AS (SELECT d || ':' || run AS s FROM runs),
{_CRC},
edited AS (
  SELECT CASE WHEN crc % 199 = 0 THEN left(run, crc % length(run)) || substr(run, crc % length(run) + 2) ELSE run END AS word, n
  FROM runs JOIN crc_of ON s = d || ':' || run),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM edited WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
places AS (SELECT word, n, unnest(range(length(word))) AS i FROM words),
gaps AS (SELECT word, n, i, left(word, i) AS a, substr(word, i + 2) AS z FROM places),
near AS (
  SELECT x.word, x.n, y.word AS other, y.n AS m FROM gaps x JOIN gaps y ON x.i = y.i AND x.a = y.a AND x.z = y.z AND x.word <> y.word
  UNION SELECT x.word, x.n, y.word, y.n FROM gaps x JOIN words y ON y.word = x.a || x.z
  UNION SELECT y.word, y.n, x.word, x.n FROM gaps x JOIN words y ON y.word = x.a || x.z),
best AS (
  SELECT word, n, other, m, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY m DESC, other) AS place FROM near),
forms AS (SELECT word, other AS form, m FROM best WHERE place = 1 AND m >= 5 * n),
steps AS (
  SELECT word, word AS root, 0 AS k FROM words
  UNION ALL
  SELECT steps.word, form, k + 1 FROM steps JOIN forms ON forms.word = steps.root),
roots AS (SELECT word, arg_max(root, k) AS root FROM steps GROUP BY word)
SELECT words.word, form, root, n, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near, m AS form_n
FROM words JOIN roots USING (word) LEFT JOIN forms USING (word) LEFT JOIN (SELECT word, n_near FROM best WHERE place = 1) USING (word)
"""


def _said(state: str, cost: str, letter: str, message: str | None = None) -> str:
    """What a node's choice costs from there on, its audit and its messages."""
    left = f"list_prepend({message}, {state}.r)" if message else f"{state}.r"
    return f"{{'c': {state}.c + {cost}, 'a': '{letter}' || {state}.a, 'r': {left}}}"


def _step() -> str:
    """The four states ahead of a line (`r`) from those after it (`f`), inserts included; s nothing, y s, u odd, a even."""
    far = "{'c': 1000000000, 'a': '', 'r': CAST([] AS VARCHAR[])}"

    def line(to: str, initial: str, role: str, more: str = "") -> str:
        kept, given = _said(f"f.{to}", "r.more", "K", "r.role || ':' || r.text"), _said(f"f.{to}", "3 + r.more", "R", f"'{role}:' || r.text")
        return f"CASE WHEN NOT r.goes AND r.initial = '{initial}' THEN {kept} ELSE {far} END, CASE WHEN NOT r.goes THEN {given} ELSE {far} END{more}"

    user, assistant = line("u", "u", "user"), line("a", "a", "assistant")
    opens = f", CASE WHEN NOT r.goes AND r.initial = 's' THEN {_said('f.y', 'r.more', 'K', 'r.role || chr(58) || r.text')} ELSE {far} END"
    ways = {"s": user + opens, "y": user, "u": assistant, "a": user}
    base = ", ".join(f"'{k}': list_min([{_said(f'f.{k}', '4', 'D')}, {w}])" for k, w in ways.items())
    inner = f"list_transform([{{{base}}}], lambda b: {{'s': b.s, 'y': b.y, 'u': list_min([b.u, {_said('b.a', '3', 'I', chr(39) + 'assistant:' + chr(39))}]), 'a': list_min([b.a, {_said('b.u', '3', 'I', chr(39) + 'user:' + chr(39))}])}})[1]"
    user_first = _said("b.u", "3", "I", "'user:'")
    return f"list_transform([{inner}], lambda b: {{'s': list_min([b.s, {user_first}]), 'y': list_min([b.y, {user_first}]), 'u': b.u, 'a': b.a}})[1]"


_END = "{'s': {'c': 0, 'a': '', 'r': CAST([] AS VARCHAR[])}, 'y': {'c': 6, 'a': 'II', 'r': ['user:', 'assistant:']}, 'u': {'c': 3, 'a': 'I', 'r': ['assistant:']}, 'a': {'c': 0, 'a': '', 'r': CAST([] AS VARCHAR[])}}"

CONVERSATIONS = rf"""
WITH RECURSIVE given AS (
  SELECT dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS g, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS s
  FROM conversations),
keyed AS (SELECT s FROM given),
{_CRC},
damaged AS (
  SELECT g, turn, CASE WHEN crc % 20 = 4 THEN 'user' ELSE role END AS role,
    CASE crc % 20 WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE crc % 20 WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM given JOIN crc_of USING (s)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY turn NULLS FIRST, role, left(text, 64), sha256(text), copy) AS i,
    regexp_extract(text, '([^ 	-])[ 	-]*$', 1) AS last
  FROM damaged),
seen AS (
  SELECT *, row_number() OVER (PARTITION BY g, role, text ORDER BY i) AS nth, left(role, 1) AS initial,
    lag(left(role, 1)) OVER (PARTITION BY g ORDER BY i) || left(role, 1) AS pair FROM placed),
judged AS (
  SELECT *, CASE WHEN last = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM seen),
lines AS (SELECT *, fault IN ('blank', 'duplicate') AS goes, CASE fault WHEN 'truncated' THEN 3 ELSE 0 END AS more FROM judged),
folded(g, i, f) AS (
  SELECT g, max(i), {_END} FROM lines GROUP BY g
  UNION ALL
  SELECT r.g, r.i - 1, {_step()} FROM folded JOIN lines r ON r.g = folded.g AND r.i = folded.i),
counts AS (
  SELECT g, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM lines GROUP BY g)
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
  CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(f.s.c, 0) AS BIGINT) AS cost,
  coalesce(f.s.a, '') AS audit, sha256(coalesce(array_to_string(f.s.r, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT g, conv_id FROM given) LEFT JOIN counts USING (g) LEFT JOIN (SELECT g, f FROM folded WHERE i = 0) USING (g)
"""
