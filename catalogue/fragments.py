"""SQL fragments shared by the checks: the same views as ``weftline.adapters``."""

from weftline.adapters import FROM_CHARS, TO_CHARS

_FROM = "'" + FROM_CHARS.replace("\n", "") + "' || chr(10)"


def bases(column: str) -> str:
    return f"translate(regexp_replace({column}, '[^A-Za-z0-9\\n]', '', 'g'), {_FROM}, '{TO_CHARS}')"


SEQS = f"seqs AS (SELECT doc_id AS name, lang AS grp, source AS hap, {bases('text')} AS seq FROM documents)"
TARGETS = f"targets AS (SELECT item_id AS target, {bases('text')} AS seq FROM benchmark)"


def hits(out: str, source: str, ids: str, k: int = 31, strand: bool = False) -> str:
    """CTE ``out`` with ids, 0-based pos and canonical k-mer text of ``source``, and whether the text itself is canonical."""
    fwd = ", f >= reverse(translate(f, 'ACGT', 'TGCA')) AS fwd" if strand else ""
    return f"""{out} AS (
  SELECT {ids}, pos, greatest(f, reverse(translate(f, 'ACGT', 'TGCA'))) AS kmer{fwd}
  FROM (SELECT {ids}, t + p AS pos, substr(tile, p + 1, {k}) AS f
        FROM (SELECT {ids}, t, tile, unnest(range(0, length(tile) - {k - 1})) AS p
              FROM (SELECT {ids}, t, substr(seq, t + 1, {255 + k}) AS tile
                    FROM (SELECT {ids}, upper(seq) AS seq, unnest(range(0, length(seq) - {k - 1}, 256)) AS t
                          FROM {source} WHERE length(seq) >= {k}))))
  WHERE f NOT LIKE '%N%')"""


DOC_HITS = SEQS + ",\n" + hits("hits", "seqs", "name, grp, hap")
TARGET_HITS = TARGETS + ",\n" + hits("thits", "targets", "target")

IVL = """ivl AS (SELECT l_suppkey AS contig, date_diff('day', DATE '1992-01-01', l_shipdate::DATE) AS start,
  date_diff('day', DATE '1992-01-01', l_shipdate::DATE) + l_quantity::BIGINT AS stop,
  CASE WHEN l_linestatus = 'O' THEN '+' ELSE '-' END AS strand, (l_orderkey * 8 + l_linenumber) * 100000000 + l_partkey * 1000 + l_suppkey AS id,
  round(l_extendedprice * 100)::BIGINT AS score, l_orderkey, l_partkey, l_linenumber, l_returnflag FROM lineitem)"""
