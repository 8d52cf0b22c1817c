"""Fill-in-middle transformation: texts are cut in three by an in-process SQL engine, an Arrow batch at a time.

Each batch is registered as a table and one SQL statement does the work, so no Python runs for a row. A text is taken apart
by ``regexp_extract_all`` into blocks of 64 code points, and only the blocks that hold a cut into single ones, so a list has
a 64th of the text's entries; ``list_slice`` and ``array_to_string`` put the parts together. All draws come from the SHA-256
of a label and the doc_id: reruns and lost executors give the same cuts.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernflow.llm import batches

BLOCK = 64
#: Text that one statement takes at a time; a longer text is taken alone.
SLICE_BYTES = 2 << 20
LABEL = "1"
PLAIN = 10
SPM = 20
CUT_SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"

#: From code point a (not included) to b of the blocks of a text.
_MACROS = f"""
CREATE MACRO units(blocks, b, i, j) AS coalesce(array_to_string(list_slice(regexp_extract_all(blocks[b // {BLOCK} + 1], '(?s).'), i, j), ''), '');
CREATE MACRO span(blocks, a, b) AS CASE WHEN a // {BLOCK} = b // {BLOCK} THEN units(blocks, a, a % {BLOCK} + 1, b % {BLOCK})
  ELSE units(blocks, a, a % {BLOCK} + 1, {BLOCK}) || coalesce(array_to_string(list_slice(blocks, a // {BLOCK} + 2, b // {BLOCK}), ''), '') || units(blocks, b, 1, b % {BLOCK}) END;
CREATE MACRO draw(digest, i) AS ('0x' || substr(digest, 8 * i + 1, 8))::BIGINT;
"""
_CUT = """
WITH named AS (SELECT doc_id, coalesce(text, '') AS text, sha256('{label}:' || coalesce(doc_id::VARCHAR, '')) AS digest FROM batch),
blocked AS (SELECT *, regexp_extract_all(text, '(?s).{{1,{block}}}') AS blocks FROM named),
counted AS (SELECT *, (CASE WHEN text = '' THEN 0 ELSE (len(blocks) - 1) * {block} + length(blocks[-1]) END)::BIGINT AS n FROM blocked),
drawn AS (SELECT *, draw(digest, 0) % (n + 1) AS one, draw(digest, 1) % (n + 1) AS two,
  CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR draw(digest, 2) % 100 >= 100 - {plain} THEN 'plain'
       WHEN draw(digest, 3) % 100 < {spm} THEN 'spm' ELSE 'psm' END AS form FROM counted),
placed AS (SELECT *, least(one, two) AS a, greatest(one, two) AS b FROM drawn),
parted AS (SELECT *, CASE WHEN form <> 'plain' THEN span(blocks, 0, a) END AS prefix, CASE WHEN form <> 'plain' THEN span(blocks, a, b) END AS middle,
  CASE WHEN form <> 'plain' THEN span(blocks, b, n) END AS suffix FROM placed)
SELECT doc_id::BIGINT AS doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END AS output
FROM parted
"""
#: A marker stands once in an output that is not plain: the text has none, and no end of one marker begins another.
_RESTORE = """
SELECT * EXCLUDE (output), output, CASE form WHEN 'plain' THEN output
  WHEN 'psm' THEN split_part(substr(output, 4), '<S>', 1) || split_part(output, '<M>', 2) || split_part(split_part(output, '<S>', 2), '<M>', 1)
  ELSE split_part(split_part(output, '<P>', 2), '<M>', 1) || split_part(output, '<M>', 2) || split_part(substr(output, 4), '<P>', 1) END AS restored
FROM batch
"""


def _slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.Table]:
    """The batch in runs of rows of ``SLICE_BYTES`` of text; a row that is longer stands alone."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > SLICE_BYTES:
            yield pa.Table.from_batches([batch.slice(start, i - start)])
            start, total = i, 0
        total += size
    if len(sizes) > start:
        yield pa.Table.from_batches([batch.slice(start)])


def _run(statement: str, column: str, schema: pa.Schema):
    """A function for mapInArrow that puts each batch through one statement; a connection serves one task."""

    def of(found: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        with duckdb.connect(config={"threads": 1, "temp_directory": ""}) as db:
            db.execute(_MACROS)
            for batch in found:
                for rows in _slices(batch, column):
                    db.register("batch", rows)
                    for out in db.sql(statement).to_arrow_reader(1024):
                        yield pa.RecordBatch.from_arrays([out.column(f.name).cast(f.type) for f in schema], schema=schema)
                    db.unregister("batch")

    return of


_LONG, _TEXT = pa.int64(), pa.string()
_CUT_ARROW = pa.schema([("doc_id", _LONG), ("n", _LONG), ("form", _TEXT), ("prefix_chars", _LONG), ("middle_chars", _LONG), ("output", _TEXT)])


def fill_in_middle(docs: DataFrame, plain: int = PLAIN, spm: int = SPM, label: str = LABEL) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) for each row of ``docs``.

    ``n`` is the text's code points. ``plain`` percent of the texts stay as they are, and so do empty ones and those that
    hold a marker; ``spm`` percent of the rest have the suffix first. A null text is empty, a null doc_id draws as the empty
    string, equal rows give equal rows, an empty table gives none; other columns are not looked at, whatever their names. A
    very long text is cut whole, at some four times its size of memory.
    """
    if not label.isalnum():
        raise ValueError("a label has letters and digits only")
    batches.bound(docs.sparkSession)
    statement = _CUT.format(label=label, block=BLOCK, plain=int(plain), spm=int(spm))
    return docs.select("doc_id", "text").mapInArrow(_run(statement, "text", _CUT_ARROW), CUT_SCHEMA)


def restore(cut: DataFrame) -> DataFrame:
    """The rows of ``fill_in_middle`` with ``restored``, the text rebuilt from output and form alone."""
    batches.bound(cut.sparkSession)
    schema = _CUT_ARROW.append(pa.field("restored", _TEXT))
    return cut.mapInArrow(_run(_RESTORE, "output", schema), f"{CUT_SCHEMA}, restored string")


def op13_infill(spark, sf_dir: str) -> DataFrame:
    """All documents cut, and restored; digests of both. Edge cases as in ``fill_in_middle``."""
    out = restore(fill_in_middle(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    digests = [F.sha2(F.col(c), 256).alias(f"{c}_sha256") for c in ("output", "restored")]
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


#: DuckDB SQL for op13_infill, by plain substrings; the restored text is the input's.
ORACLE = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
d AS (SELECT *, ('0x' || h[1:8])::BIGINT % (n + 1) AS x, ('0x' || h[9:16])::BIGINT % (n + 1) AS y,
  CASE WHEN text = '' OR regexp_matches(text, '<[PSM]>') OR ('0x' || h[17:24])::BIGINT % 100 >= 90 THEN 'plain'
       WHEN ('0x' || h[25:32])::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM t),
p AS (SELECT *, left(text, least(x, y)) AS prefix, substr(text, least(x, y) + 1, abs(x - y)) AS middle, substr(text, greatest(x, y) + 1) AS suffix FROM d)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN least(x, y) END AS prefix_chars, CASE WHEN form <> 'plain' THEN abs(x - y) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN concat('<P>', prefix, '<S>', suffix, '<M>', middle)
    ELSE concat('<S>', suffix, '<P>', prefix, '<M>', middle) END) AS output_sha256, sha256(text) AS restored_sha256
FROM p
"""
