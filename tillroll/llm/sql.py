"""DuckDB SQL for the queries that SQL can express, by plainer ways than the operators'."""

from __future__ import annotations

from itertools import permutations

from tillroll.llm import secret_scan

OP4 = r"""
WITH texts AS (
    SELECT doc_id, length(coalesce(text, '')) AS points,
        sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
    FROM documents)
SELECT doc_id,
    first_value(doc_id) OVER best AS keep_id,
    count(*) OVER (PARTITION BY text_sha256) AS group_size,
    row_number() OVER best = 1 AS kept,
    text_sha256
FROM texts
WINDOW best AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id)
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("\\\"", '"').replace("'", "''") + "'"


def _matches(pattern: str, group: int) -> str:
    """(row, start, hit, part) of every match."""
    p = _quoted(pattern)
    return f"""
        SELECT row, hits[i] AS hit, parts[i] AS part,
            list_sum(list_transform(gaps[1:i], lambda x: length(x)))
                + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS start
        FROM (
            SELECT row, gaps, hits, parts, unnest(range(1, len(hits) + 1)) AS i
            FROM (
                SELECT row, string_split_regex(t, {p}) AS gaps,
                    regexp_extract_all(t, {p}) AS hits,
                    regexp_extract_all(t, {p}, {group}) AS parts
                FROM texts))"""


def secret_scan_sql() -> str:
    window = secret_scan.WINDOW
    base = " UNION ALL ".join(
        f"""SELECT row, '{k.name}' AS kind, {i} AS rank, start, start + length(hit) AS stop
        FROM ({_matches(k.pattern, k.group)}) WHERE length(part) >= {k.least}"""
        for i, k in enumerate(secret_scan.KINDS)
    )
    limits = " ".join(
        f"WHEN regexp_matches(hit, {_quoted(form)}) THEN {secret_scan.limit(bits, window)}"
        for _, form, bits in secret_scan.CLASSES
    )
    allowed = " OR ".join(
        f"regexp_matches(hit, {_quoted(form)})" for form in secret_scan.ALLOWED
    )
    weights = [secret_scan.weight(c) for c in range(window + 1)]
    counts = "".join(
        f", count(kind) FILTER (kind = '{k.name}') AS n_{k.name}" for k in secret_scan.KINDS
    )
    joined = "coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank){}, '')"
    return f"""
WITH texts AS (
    SELECT doc_id, row_number() OVER () AS row, coalesce(text, '') AS t FROM documents),
base AS ({base}),
candidates AS (
    SELECT row, start, hit, CASE {limits} ELSE -1 END AS most
    FROM ({_matches(secret_scan.CANDIDATE, 0)})
    WHERE NOT ({allowed})),
windows AS (
    SELECT row, start, most, length(hit) AS size, substr(hit, pos + 1, {window}) AS part
    FROM (SELECT *, unnest(range(0, length(hit) - {window} + 1)) AS pos FROM candidates)),
heavy AS (
    SELECT row, start, most, size, part,
        list_sum(list_transform(list_distinct(string_split(part, '')),
            lambda c: {weights}[len(list_filter(string_split(part, ''), lambda x: x = c)) + 1])
        ) AS total
    FROM windows),
stretches AS (
    SELECT DISTINCT row, 'entropy' AS kind, {len(secret_scan.KINDS)} AS rank,
        start, start + size AS stop
    FROM heavy WHERE total <= most
        AND NOT regexp_matches(part, {_quoted(secret_scan.ALLOWED_WINDOW)})
        AND NOT contains({_quoted(secret_scan.ALPHABET)}, lower(part))),
added AS (
    SELECT * FROM stretches s WHERE NOT EXISTS (
        SELECT 1 FROM base b WHERE b.row = s.row AND b.start <= s.start AND b.stop >= s.stop)),
spans AS (SELECT * FROM base UNION ALL SELECT * FROM added)
SELECT doc_id{counts},
    sha256({joined.format(" FILTER (kind <> 'entropy')")}) AS base_sha256,
    {joined.format('')} AS spans
FROM texts LEFT JOIN spans USING (row) GROUP BY row, doc_id"""


def _levels(name: str, leaves: str) -> str:
    """Every node of the trees over `leaves` (grp, idx, d), and the children of every parent."""
    return f"""{name} AS (
    SELECT grp, 0 AS lvl, idx, d, count(*) OVER (PARTITION BY grp) AS n FROM {leaves}
    UNION ALL
    SELECT grp, lvl + 1, idx // 3, sha256(string_agg(d, '' ORDER BY idx)), (any_value(n) + 2) // 3
    FROM {name} WHERE n > 1 GROUP BY grp, lvl, idx // 3),
{name}_kids AS (
    SELECT grp, lvl, idx // 3 AS parent, list(d ORDER BY idx) AS kids
    FROM {name} WHERE n > 1 GROUP BY grp, lvl, idx // 3)"""


def merkle_sql() -> str:
    def field(column: str) -> str:
        spelt = f"CAST({column} AS VARCHAR)"
        return f"coalesce(strlen({spelt}) || ':' || {spelt}, '-')"

    head = " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars"))
    # The checksum of a decimal, bit by bit and byte by byte.
    bit = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    return f"""
WITH RECURSIVE
checks AS (
    SELECT DISTINCT CAST(doc_id AS VARCHAR) AS s, CAST(4294967295 AS BIGINT) AS c, 0 AS k
    FROM documents WHERE doc_id IS NOT NULL
    UNION ALL
    SELECT s, CASE WHEN k % 9 = 0 THEN xor(c, ascii(substr(s, k // 9 + 1, 1))) ELSE {bit} END, k + 1
    FROM checks WHERE k < 9 * length(s)),
even AS (SELECT s FROM checks WHERE k = 9 * length(s) AND xor(c, 4294967295) % 2 = 0),
docs AS (
    SELECT row_number() OVER () AS row, doc_id, coalesce('s' || source, '') AS grp,
        sha256({head} || {field("text")}) AS leaf,
        sha256({head} || {field("replace(text, chr(10), '')")}) AS flat,
        CAST(doc_id AS VARCHAR) IN (SELECT s FROM even) AS is_even
    FROM documents),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx
    FROM docs),
leaves AS (SELECT grp, idx, leaf AS d FROM placed),
{_levels("own", "leaves")},
subroots AS (
    SELECT '' AS grp, row_number() OVER (ORDER BY grp) - 1 AS idx, d, grp AS key, lvl
    FROM own WHERE n = 1),
{_levels("top", "subroots")},
climb AS (
    SELECT row, grp, 0 AS lvl, idx, CASE WHEN is_even THEN flat ELSE leaf END AS d, '' AS proof
    FROM placed
    UNION ALL
    SELECT row, grp, lvl + 1, idx // 3,
        sha256(array_to_string(kids[1:idx % 3] || [d] || kids[idx % 3 + 2:], '')),
        proof || array_to_string(kids[1:idx % 3] || kids[idx % 3 + 2:], '')
    FROM climb JOIN own_kids USING (grp, lvl) WHERE parent = idx // 3),
upper AS (
    SELECT row, '' AS grp, 0 AS lvl, s.idx, climb.d, proof
    FROM climb JOIN subroots s ON climb.grp = s.key AND climb.lvl = s.lvl
    UNION ALL
    SELECT row, grp, lvl + 1, idx // 3,
        sha256(array_to_string(kids[1:idx % 3] || [d] || kids[idx % 3 + 2:], '')),
        proof || array_to_string(kids[1:idx % 3] || kids[idx % 3 + 2:], '')
    FROM upper JOIN top_kids USING (grp, lvl) WHERE parent = idx // 3)
SELECT doc_id, leaf, s.d AS subroot, r.d AS root, sha256(proof) AS proof_sha256,
    upper.d AS folded_root, upper.d = r.d AS verified
FROM placed JOIN subroots s ON placed.grp = s.key
JOIN (SELECT d, lvl FROM top WHERE n = 1) r ON true
JOIN upper ON upper.row = placed.row AND upper.lvl = r.lvl
"""


UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def decontaminate_sql() -> str:
    """All windows of all documents, joined as text."""

    def words(column: str) -> str:
        low = f"translate(coalesce({column}, ''), '{UPPER}', '{UPPER.lower()}')"
        return rf"regexp_extract_all({low}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

    return f"""
WITH items AS (SELECT item_id, {words("text")} AS w FROM benchmark),
item_windows AS (
    SELECT DISTINCT item_id, n, array_to_string(w[k:k + n - 1], ' ') AS gram
    FROM (
        SELECT *, unnest(range(1, len(w) - n + 2)) AS k
        FROM (SELECT *, least(len(w), 10) AS n FROM items WHERE len(w) > 0))),
docs AS (SELECT row_number() OVER () AS row, doc_id, {words("text")} AS w FROM documents),
doc_windows AS (
    SELECT row, n, k, array_to_string(w[k:k + n - 1], ' ') AS gram
    FROM (
        SELECT row, w, n, unnest(range(1, len(w) - n + 2)) AS k
        FROM docs, (SELECT DISTINCT n FROM item_windows) WHERE len(w) >= n)),
hits AS (SELECT * FROM doc_windows JOIN item_windows USING (n, gram)),
hit_words AS (
    SELECT row, count(DISTINCT word) AS n_hit
    FROM (SELECT row, unnest(range(k, k + n)) AS word FROM hits) GROUP BY row),
found AS (
    SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
    FROM (SELECT DISTINCT row, CAST(item_id AS VARCHAR) AS item FROM hits WHERE item_id IS NOT NULL)
    GROUP BY row)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit_words USING (row) LEFT JOIN found USING (row)
"""


def filter_audit_sql() -> str:
    """Every order played through on every document."""
    names = ", ".join(f"('{''.join(p)}')" for p in permutations("ABCDE"))
    return rf"""
WITH texts AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
failing AS (
    SELECT doc_id, part,
        CASE WHEN len(w) < 50 THEN 'A' ELSE '' END
        || CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' ELSE '' END
        || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t)
            THEN 'C' ELSE '' END
        || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
        || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails
    FROM texts),
labelled AS (
    SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
docs AS (
    SELECT part, fails, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
    FROM failing LEFT JOIN labelled USING (doc_id)),
orders AS (SELECT * FROM (VALUES {names}) AS o(filter_order)),
steps AS (
    SELECT filter_order, step, substr(filter_order, step, 1) AS f,
        substr(filter_order, 1, step - 1) AS before
    FROM orders, (SELECT unnest(range(1, 6)) AS step)),
played AS (
    SELECT part, filter_order, step, f, fails, good, toxic, contains(fails, f) AS bad,
        translate(fails, before, '') = fails AS here
    FROM docs, steps),
counted AS (
    SELECT part, filter_order, step, f,
        count(*) FILTER (here AND NOT bad) AS kept,
        count(*) FILTER (here AND bad) AS removed,
        count(*) FILTER (bad AND NOT here) AS redundant,
        count(*) FILTER (fails = f) AS unique_fails,
        count(*) FILTER (here AND bad AND good) AS good_lost,
        count(*) FILTER (here AND bad AND toxic) AS toxic_lost
    FROM played GROUP BY part, filter_order, step, f)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM counted
"""


ORACLES = {
    "op4_exact_dedup": OP4,
    "op10_secret_scan": secret_scan_sql(),
    "op11_decontaminate": decontaminate_sql(),
    "op12_filter_audit": filter_audit_sql(),
    "op13_merkle_manifest": merkle_sql(),
}
