"""SQL that returns the same rows as registered queries, for DuckDB."""

from __future__ import annotations

_UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"


def _draw(k: int) -> str:
    return f"CAST('0x' || substr(digest, {8 * k + 1}, 8) AS BIGINT)"


FILL_IN_MIDDLE = f"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_UNIT}') AS units,
         sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest
  FROM documents),
drawn AS (
  SELECT doc_id, text, units, len(units) AS n,
         {_draw(0)} % (len(units) + 1) AS one, {_draw(1)} % (len(units) + 1) AS two,
         text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
           OR {_draw(2)} % 100 >= 50 AS plain,
         {_draw(3)} % 100 < 80 AS spm
  FROM cut),
pieces AS (
  SELECT doc_id, text, CAST(n AS BIGINT) AS n,
         CASE WHEN plain THEN 'plain' WHEN spm THEN 'spm' ELSE 'psm' END AS form,
         array_to_string(units[1:least(one, two)], '') AS prefix,
         array_to_string(units[least(one, two) + 1:greatest(one, two)], '') AS middle,
         array_to_string(units[greatest(one, two) + 1:], '') AS suffix
  FROM drawn)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
              WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM pieces"""


def _field(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || {value}, '-')"


def _leaf(text: str) -> str:
    fields = ("doc_id", "source", "lang", "n_chars", text)
    return f"sha256({' || '.join(_field(f) for f in fields)})"


def merkle(levels: int = 8) -> str:
    """The Merkle query for up to ``8 ** levels`` documents a language, and as many languages.

    DuckDB has no crc32: it is written out over the digits of the id, with its table.
    """
    steps = [
        f"""leaves AS MATERIALIZED (
  SELECT doc_id, lang, {_leaf("text")} AS leaf, {_leaf(_LOWERED)} AS tampered, {_CRC} % 3 = 0 AS hit
  FROM documents, crc_table),
trees AS MATERIALIZED (
  SELECT lang, count(*) AS n, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS tree
  FROM leaves GROUP BY lang),
places AS MATERIALIZED (
  SELECT tree, doc_id, leaf, tampered, hit,
         row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
  FROM leaves JOIN trees ON leaves.lang IS NOT DISTINCT FROM trees.lang),
n0 AS MATERIALIZED (SELECT tree, pos, leaf AS d, n FROM places JOIN trees USING (tree))"""
    ]
    steps += [_raised(f"n{k}", f"n{k + 1}") for k in range(levels)]
    steps.append(
        f"m0 AS MATERIALIZED (SELECT CAST(-1 AS BIGINT) AS tree, tree AS pos, d, (SELECT count(*) FROM trees) AS n "
        f"FROM n{levels})"
    )
    steps += [_raised(f"m{k}", f"m{k + 1}") for k in range(levels)]
    steps.append(
        "f0 AS MATERIALIZED (SELECT doc_id, tree, pos, leaf, CASE WHEN hit THEN tampered ELSE leaf END AS own, '' AS proof FROM places)"
    )
    steps += [_folded(f"f{k}", f"n{k}", f"f{k + 1}") for k in range(levels)]
    steps.append(
        f"g0 AS MATERIALIZED (SELECT doc_id, tree AS lang_tree, CAST(-1 AS BIGINT) AS tree, tree AS pos, leaf, own, proof FROM f{levels})"
    )
    steps += [_folded(f"g{k}", f"m{k}", f"g{k + 1}", "lang_tree, ") for k in range(levels)]
    return f"""
WITH {_TABLE},
{", ".join(steps)}
SELECT doc_id, leaf, s.d AS subroot, r.d AS root, sha256(proof) AS proof_sha256,
       own AS folded_root, own = r.d AS verified
FROM g{levels} JOIN n{levels} AS s ON s.tree = g{levels}.lang_tree CROSS JOIN m{levels} AS r"""


def _raised(below: str, above: str) -> str:
    return f"""{above} AS MATERIALIZED (
  SELECT tree, pos // 8 AS pos, sha256(string_agg(d, '' ORDER BY pos)) AS d, (n + 7) // 8 AS n
  FROM {below} WHERE n > 1 GROUP BY tree, pos // 8, n
  UNION ALL SELECT tree, pos, d, n FROM {below} WHERE n = 1)"""


def _folded(now: str, nodes: str, then: str, more: str = "") -> str:
    return f"""r_{nodes} AS MATERIALIZED (
  SELECT tree, pos // 8 AS run, list(d ORDER BY pos) AS ds FROM {nodes} WHERE n > 1 GROUP BY tree, pos // 8),
{then} AS MATERIALIZED (
  SELECT doc_id, {more}tree, CASE WHEN ds IS NULL THEN pos ELSE pos // 8 END AS pos, leaf,
         CASE WHEN ds IS NULL THEN own
              ELSE sha256(array_to_string(ds[1:pos % 8], '') || own || array_to_string(ds[pos % 8 + 2:], '')) END AS own,
         CASE WHEN ds IS NULL THEN proof
              ELSE proof || array_to_string(ds[1:pos % 8], '') || array_to_string(ds[pos % 8 + 2:], '') END AS proof
  FROM {now} LEFT JOIN r_{nodes} USING (tree) WHERE run IS NULL OR run = pos // 8)"""


_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TABLE = """crc_table AS MATERIALIZED (
  SELECT list_transform(range(256), lambda b: list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0],
         lambda c, i: xor(c >> 1, (c & 1) * 3988292384))) AS t)"""
_CRC = """xor(4294967295, list_reduce([CAST(4294967295 AS BIGINT)]
    || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])))"""

MERKLE_MANIFEST = merkle()
