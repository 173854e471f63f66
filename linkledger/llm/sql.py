"""DuckDB SQL for the queries of this package that SQL can express on the given tables."""

from __future__ import annotations

from linkledger.llm.collocations import _ENDS as ENDS

_LOWER = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

EXACT_DEDUP = f"""
    SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
           doc_id = max(doc_id) OVER g AS kept, sha256(t) AS text_sha256
    FROM (SELECT doc_id, {_LOWER.format('text')} AS t FROM documents)
    WINDOW g AS (PARTITION BY t)"""


def _leaf(text: str) -> str:
    fields = ["doc_id", "source", "lang", "n_chars", text]
    one = [f"coalesce(strlen(CAST({f} AS VARCHAR)) || ':' || CAST({f} AS VARCHAR), '-')" for f in fields]
    return f"sha256({' || '.join(one)})"


def _tree(name: str, levels: int) -> list[str]:
    """Levels ``name``1 and up of the groups g of ``name``0 (g, x, h, depth), and the runs of each level."""
    out = []
    for j in range(levels):
        out.append(f"{name}{j + 1} AS (SELECT g, depth, x // 16 AS x, "
                   f"CASE WHEN depth > {j} THEN sha256(string_agg(h, '' ORDER BY x)) ELSE min(h) END AS h "
                   f"FROM {name}{j} GROUP BY g, depth, x // 16)")
        out.append(f"{name}_run{j} AS (SELECT g, x // 16 AS x, list(h ORDER BY x) AS h FROM {name}{j} WHERE depth > {j} GROUP BY g, x // 16)")
    return out


def _fold(start: str, name: str, tree: str, levels: int, key: str, place: str) -> list[str]:
    """``name``1 and up: the rows of ``start`` with node and proof taken one level further each."""
    out, before = [], start
    for j in range(levels):
        pos = f"(f.{place} // {16**j}) % 16"
        left, right = f"array_to_string(r.h[1:{pos}], '')", f"array_to_string(r.h[{pos} + 2:16], '')"
        out.append(f"{name}{j + 1} AS (SELECT f.* EXCLUDE (node, proof), "
                   f"CASE WHEN r.h IS NULL THEN node ELSE sha256({left} || node || {right}) END AS node, "
                   f"CASE WHEN r.h IS NULL THEN proof ELSE proof || {left} || {right} END AS proof "
                   f"FROM {before} f LEFT JOIN {tree}_run{j} r ON r.g = f.{key} AND r.x = f.{place} // {16 ** (j + 1)})")
        before = f"{name}{j + 1}"
    return out


def manifest(levels: int = 6, top: int = 3) -> str:
    """Leaves, roots and proofs, for sources of at most 16^levels rows and at most 16^top sources."""
    depth = " + ".join(f"CAST({{0}} > {16**i} AS INT)" for i in range(levels))
    parts = [
        "crc_table AS (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(CAST(i AS BIGINT), CAST([0, 0, 0, 0, 0, 0, 0, 0] "
        "AS BIGINT[])), lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) s(i)))",
        "sums AS (SELECT *, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), "
        "lambda c: CAST(ascii(c) AS BIGINT))), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS crc FROM documents, crc_table)",
        f"leaves AS (SELECT doc_id, coalesce('=' || source, '') AS g, {_leaf('text')} AS leaf, "
        f"CASE WHEN crc % 5 = 0 AND text IS NOT NULL THEN {_leaf(_LOWER.format('text'))} END AS tampered FROM sums)",
        f"placed AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS x, "
        f"{depth.format('count(*) OVER (PARTITION BY g)')} AS depth FROM leaves)",
        "doc0 AS (SELECT g, x, leaf AS h, depth FROM placed)",
        *_tree("doc", levels),
        f"subroots AS (SELECT g, h AS subroot, row_number() OVER (ORDER BY g) - 1 AS s, {depth.format('count(*) OVER ()')} AS depth FROM doc{levels})",
        "src0 AS (SELECT '' AS g, s AS x, subroot AS h, depth FROM subroots)",
        *_tree("src", top),
        "fold0 AS (SELECT p.*, subroot, s, '' AS one, coalesce(tampered, leaf) AS node, '' AS proof FROM placed p JOIN subroots USING (g))",
        *_fold("fold0", "fold", "doc", levels, "g", "x"),
        *_fold(f"fold{levels}", "up", "src", top, "one", "s"),
    ]
    return "WITH " + ",\n".join(parts) + f"""
        SELECT doc_id, leaf, subroot, r.h AS root, sha256(proof) AS proof_sha256, node AS folded_root, node = r.h AS verified
        FROM up{top} u, src{top} r"""


def collocations(least: int = 30, top: int = 2000) -> str:
    ends = "".join(f"\\x{ord(c):02x}" for c in ENDS)
    grams = " UNION ALL ".join(
        f"SELECT lang, {k} AS k, array_to_string(w[i:i + {k - 1}], ' ') AS phrase FROM split, unnest(range(1, len(w) - {k - 2})) u(i)" for k in range(1, 5))
    subs = [(k, i) for k in (2, 3) for i in (1, 2, 3) if i + k <= 5]
    inside = " UNION ALL ".join(
        f"SELECT lang, array_to_string(q[{i}:{i + k - 1}], ' ') AS phrase, a FROM cand WHERE k > {k} AND k >= {i + k - 1}" for k, i in subs)
    cuts = " UNION ALL ".join(
        f"SELECT lang, k, phrase, a, {c} AS cut, array_to_string(q[1:{c}], ' ') AS first, array_to_string(q[{c + 1}:k], ' ') AS rest FROM cand WHERE k > {c}"
        for c in (1, 2, 3))
    return f"""
        WITH split AS (
            SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM (
                SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER.format('text')}, '[{ends}]')) AS piece FROM documents)),
        totals AS (SELECT lang, sum(len(w)) AS n FROM split GROUP BY lang),
        f AS (SELECT lang, k, phrase, count(*) AS a FROM ({grams}) GROUP BY lang, k, phrase),
        cand AS (SELECT *, string_split(phrase, ' ') AS q FROM f WHERE k > 1 AND a >= {least}),
        gone AS (SELECT lang, phrase, max(a) AS longer FROM ({inside}) GROUP BY lang, phrase),
        cut AS (
            SELECT c.lang, c.phrase, c.a, cut, x.a AS l, y.a AS r, CAST(2000000 AS HUGEINT) * c.a // (x.a + y.a) AS score
            FROM ({cuts}) c JOIN f x ON x.lang = c.lang AND x.phrase = c.first JOIN f y ON y.lang = c.lang AND y.phrase = c.rest),
        best AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS b FROM cut),
        kept AS (
            SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank
            FROM best b LEFT JOIN gone g ON g.lang = b.lang AND g.phrase = b.phrase
            WHERE b = 1 AND (longer IS NULL OR 100 * longer < 80 * a))
        SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
        FROM kept JOIN totals USING (lang) WHERE rank <= {top}"""
