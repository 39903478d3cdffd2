"""Readers for labelled sheets, review tables, token corpora and reports."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from reviewlens.functions.arrays import let
from reviewlens.functions.fixed_values import MISSING_TEXTS
from reviewlens.functions.text import SPACE_CHARS, strip_spaces
from reviewlens.operators.labels import drop_incomplete, require_columns
from reviewlens.session import stored

# The functions on Arrow batches travel to the workers by value, so they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def read_table(spark: SparkSession, path: str, format: str = "csv", multi_line: bool = True) -> DataFrame:
    """A text table with header; every column is a string in CSV.

    With ``multi_line`` quoted cells may span lines, and every file is read by one task. Turn it off where
    cells hold no line breaks: large files are then split. Parquet is the format for large tables.
    """
    if format == "csv":
        return spark.read.csv(path, header=True, multiLine=multi_line, quote='"', escape='"', encoding="UTF-8")
    return spark.read.format(format).load(path)


def read_labelled_raw(
    spark: SparkSession, path: str, positions: Sequence[int] = (6, 7, 8), format: str = "csv", multi_line: bool = True
) -> DataFrame:
    """Text, aspect and sentiment of a raw sheet, picked by column position."""
    table = read_table(spark, path, format, multi_line)
    numbered = table.toDF(*[f"_{i}" for i in range(len(table.columns))])
    return numbered.select(
        *[F.col(f"_{p}").alias(name) for p, name in zip(positions, ("text", "aspect", "sentiment"))]
    )


def read_reviews(
    spark: SparkSession,
    path: str,
    required: Sequence[str] = ("text", "aspect", "sentiment"),
    format: str = "csv",
    missing: Sequence[str] = MISSING_TEXTS,
    multi_line: bool = True,
) -> DataFrame:
    """Labelled reviews without rows that miss a required value; ``missing`` spells it in CSV files only."""
    table = require_columns(read_table(spark, path, format, multi_line), required)
    return drop_incomplete(table, required, missing if format == "csv" else ())


def read_batch(spark: SparkSession, path: str, format: str = "csv", multi_line: bool = True) -> DataFrame:
    """Reviews to score; the table must have a ``text`` column."""
    return require_columns(read_table(spark, path, format, multi_line), ["text"])


def bio_rows(lines: DataFrame, fields: Column, with_pos: bool) -> DataFrame:
    width = 4 if with_pos else 3
    # An explode of one line or none: a filter would take the line apart once more for each of its conditions.
    known = lambda f: F.when((F.size(f) == width) & (F.get(f, F.lit(0)) != "sentence_id"), f)
    kept = lines.select("*", F.explode(F.array_compact(F.transform(F.array(fields), known))).alias("_f"))
    return kept.select(
        "*",
        F.get("_f", F.lit(0)).cast("long").alias("doc_id"),
        F.get("_f", F.lit(width - 2)).alias("token"),
        F.get("_f", F.lit(width - 1)).alias("label"),
    )


def read_bio_tsv(spark: SparkSession, path: str, with_pos: bool = True) -> DataFrame:
    """Token table ``(doc_id, pos, token, label)``; the header, blank and malformed lines are skipped.

    Without a position column the order of the lines counts. It is restored from the file name, the
    offset of the file block and the running row number inside the block.
    """
    source = spark.read.text(path)
    fields = F.split(strip_spaces(F.col("value")), "\t")
    if with_pos:
        rows = bio_rows(source, fields, True)
        return rows.select("doc_id", F.get("_f", F.lit(1)).cast("int").alias("pos"), "token", "label")
    placed = source.select(
        "value",
        F.struct(
            F.col("_metadata.file_path"),
            F.col("_metadata.file_block_start"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("_at"),
    )
    in_sentence = Window.partitionBy("doc_id").orderBy("_at")
    rows = bio_rows(placed, fields, False)
    return rows.select("doc_id", (F.row_number().over(in_sentence) - 1).alias("pos"), "token", "label")


def read_bio_sentences(spark: SparkSession, path: str) -> DataFrame:
    """Token table ``(doc_id, pos, token, label)`` of files whose blank lines end the sentences.

    The ids in the files are ignored, so files that use the same ids can be read together: ``doc_id`` numbers
    the sentences in the order of the files' paths, with gaps where blank lines follow each other. The end of a file ends its last sentence. Lines of other
    than three fields, the header among them, are skipped and end nothing.

    A file is read in blocks, and the lines of a block stay in order in one task, which takes them apart, counts its blank lines and the
    tokens since the last. A first pass leaves one row per block; what the blocks before hold is then added to these counts. No line is shuffled.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")
    by_block = lines.mapInArrow(_block_sums, "file string, start long, _blanks long, _tail long")
    by_block = stored(by_block, "blocks")
    # One row per block, then one per file: small whatever the files hold.
    in_file = Window.partitionBy("file").orderBy("start")
    by_file = by_block.groupBy("file").agg((F.sum("_blanks") + 1).alias("_ends"))
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    by_file = by_file.select("file", F.coalesce(F.sum("_ends").over(earlier), F.lit(0)).alias("_first"))
    offsets = by_block.withColumn("_upto", F.sum("_blanks").over(in_file))
    # Tokens of the sentence that a block leaves open, those of the blocks it began in included.
    offsets = offsets.withColumn("_open", F.sum("_tail").over(Window.partitionBy("file", "_upto").orderBy("start")))
    offsets = offsets.withColumn("_carried", F.lag("_open", 1, 0).over(in_file)).join(by_file, "file")
    offsets = offsets.select("file", "start", (F.col("_first") + F.col("_upto") - F.col("_blanks")).alias("_offset"), "_carried")
    before = {(r["file"], r["start"]): (r["_offset"], r["_carried"]) for r in offsets.collect()}
    return lines.mapInArrow(_numbered(before), "doc_id long, pos int, token string, label string")


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], int, int]]:
    """``(file, start)`` of the blocks in a batch of lines, with the first and the end of their rows."""
    files, starts = batch.column(0), batch.column(1)
    new = np.ones(batch.num_rows, dtype=bool)
    if batch.num_rows > 1:
        same = pc.and_(pc.equal(files[1:], files[:-1]), pc.equal(starts[1:], starts[:-1]))
        new[1:] = ~same.to_numpy(zero_copy_only=False)
    begins = np.flatnonzero(new).tolist()
    for begin, end in zip(begins, [*begins[1:], batch.num_rows]):
        yield (files[begin].as_py(), starts[begin].as_py()), begin, end


def _stripped(lines: pa.Array) -> pa.Array:
    """``strip_spaces`` for an Arrow column."""
    try:
        return pc.utf8_trim(lines, SPACE_CHARS)
    except pa.ArrowInvalid:  # some bytes are no UTF-8; they stay as they are
        texts = (line.as_buffer().to_pybytes().decode("utf-8", "surrogateescape") for line in lines)
        found = pa.array([t.strip(SPACE_CHARS).encode("utf-8", "surrogateescape") for t in texts], pa.binary())
        return pc.cast(found, options=pc.CastOptions(target_type=pa.string(), allow_invalid_utf8=True))


def _flags(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Which of the stripped lines are blank, and which have three fields and are no header."""
    kept = pc.and_not(pc.equal(pc.count_substring(lines, "\t"), 2), pc.starts_with(lines, "sentence_id\t"))
    return tuple(x.to_numpy(zero_copy_only=False).astype(np.int64) for x in (pc.equal(pc.binary_length(lines), 0), kept))


def _block_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From lines ``(file, start, value)`` one row per block: its blank lines, and the kept lines after the last of them."""
    now, done = None, []
    for batch in batches:
        blank, kept = _flags(_stripped(batch.column(2)))
        for block, begin, end in _blocks(batch):
            if now is None or now[0] != block:
                done += [now] if now else []
                now = (block, 0, 0)
            ends = np.flatnonzero(blank[begin:end])
            tail = int(kept[begin + (ends[-1] if len(ends) else 0) : end].sum())
            now = (block, now[1] + len(ends), tail if len(ends) else now[2] + tail)
    done += [now] if now else []
    columns = zip(*[(*block, blanks, tail) for block, blanks, tail in done]) if done else [[]] * 4
    types = (pa.string(), pa.int64(), pa.int64(), pa.int64())
    yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], ["file", "start", "_blanks", "_tail"])


def _numbered(before: dict) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Task function: the fields of the kept ones of lines ``(file, start, value)`` with their sentence and place.

    ``before`` has the sentences before every block, and the tokens before it of the sentence it goes on with.
    """

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ended, at = None, 0, 0
        for batch in batches:
            lines = _stripped(batch.column(2))
            blank, kept = _flags(lines)
            ids, places = np.zeros(batch.num_rows, dtype=np.int64), np.zeros(batch.num_rows, dtype=np.int32)
            for block, begin, end in _blocks(batch):
                if block != now:
                    now, (ended, at) = block, before[block]
                own, found = np.cumsum(blank[begin:end]), np.cumsum(kept[begin:end])
                earlier = found - kept[begin:end]
                # What was kept up to the last blank line; a blank line itself is never kept.
                reset = np.maximum.accumulate(np.where(blank[begin:end] > 0, earlier, -at))
                ids[begin:end], places[begin:end] = ended + own, earlier - reset
                ended, at = ended + int(own[-1]), int(found[-1] - reset[-1])
            here = kept > 0
            fields = pc.split_pattern(lines.filter(pa.array(here)), "\t").flatten()
            token, label = (fields.take(pa.array(np.arange(k, len(fields), 3))) for k in (1, 2))
            yield pa.RecordBatch.from_arrays([pa.array(ids[here]), pa.array(places[here]), token, label], ["doc_id", "pos", "token", "label"])

    return number


#: Stands between the values of a packed run; runs with values that hold it are not packed.
MARK = "\x1f"


def _runs(batches: Iterator[pa.RecordBatch], in_steps: bool = False) -> Iterator[pa.RecordBatch]:
    """Rows ``(id, pos, token, label)`` of an id that follow each other become one row.

    Where positions count up by one and no value is null, tokens and labels are packed into one string each, which
    shuffles in a fifth of the bytes; else they become arrays. With ``in_steps`` a run also ends where positions do not
    count up by one, and ``first`` is the place of every run.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        runs = pc.run_end_encode(batch.column(0))
        at = np.concatenate([[0], runs.run_ends.to_numpy(zero_copy_only=False)])
        pos = batch.column(1)
        if in_steps:
            steps = pc.fill_null(pc.equal(pc.subtract(pos[1:], pos[:-1]), 1), False)
            at = np.union1d(at, 1 + np.flatnonzero(~steps.to_numpy(zero_copy_only=False)))
        n = len(at) - 1
        packed = not any(c.null_count for c in batch.columns[1:])
        packed = packed and not any(pc.any(pc.match_substring(c, MARK)).as_py() for c in batch.columns[2:])
        if packed:
            steps = np.diff(pos.to_numpy(zero_copy_only=False)) == 1
            steps[at[1:-1] - 1] = True
            packed = steps.all()
        bounds = pa.array(at, pa.int32())
        lists = [pa.ListArray.from_arrays(bounds, c) for c in batch.columns[1:]]
        begins = pa.array(at[:-1])
        first = pos.take(begins) if packed or in_steps else pa.nulls(n, pos.type)
        joined = [pc.binary_join(x, MARK) if packed else pa.nulls(n, pa.string()) for x in lists[1:]]
        kept = [pa.nulls(n, x.type) if packed else x for x in lists]
        yield pa.RecordBatch.from_arrays([batch.column(0).take(begins), first, *joined, *kept], ["doc_id", "first", "tokens", "labels", "pos", "token", "label"])


def _run_schema(rows: DataFrame) -> StructType:
    arrays = [StructField(c, ArrayType(rows.schema[c].dataType)) for c in ("pos", "token", "label")]
    packed = [StructField("first", rows.schema["pos"].dataType), StructField("tokens", StringType()), StructField("labels", StringType())]
    return StructType([rows.schema["doc_id"], *packed, *arrays])


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows that ``_runs`` gathered, in the order of the runs."""
    for batch in batches:
        packed = batch.column(2).is_valid().to_numpy(zero_copy_only=False)
        cuts = [0, *(1 + np.flatnonzero(np.diff(packed))).tolist(), batch.num_rows] if batch.num_rows else []
        for begin, end in zip(cuts, cuts[1:]):
            doc_id, first, tokens, labels, *arrays = batch.slice(begin, end - begin).columns
            if packed[begin]:
                token, label = (pc.split_pattern(c, MARK) for c in (tokens, labels))
                sizes = pc.list_value_length(token).to_numpy()
                run = np.repeat(np.arange(len(sizes)), sizes)
                place = np.arange(len(run)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                pos = pa.array(first.to_numpy()[run] + place).cast(first.type)
            else:
                pos, token, label = arrays
                run, pos = pc.list_parent_indices(pos), pos.flatten()
            yield pa.RecordBatch.from_arrays([doc_id.take(pa.array(run)), pos, token.flatten(), label.flatten()], ["doc_id", "pos", "token", "label"])


def ordered_rows(rows: DataFrame) -> DataFrame:
    """Token rows in ranges of ``doc_id``, in the order of ids and places.

    What is shuffled and sorted are runs of rows whose positions count up, packed, and not the rows. Runs that overlap, which
    only sentences of the same id do, follow each other.
    """
    rows = rows.select("doc_id", "pos", F.col("token").cast("string").alias("token"), F.col("label").cast("string").alias("label"))
    runs = rows.mapInArrow(lambda batches: _runs(batches, in_steps=True), _run_schema(rows))
    return runs.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "first").mapInArrow(_unpacked, rows.schema)


def sentences(rows: DataFrame) -> DataFrame:
    """``(doc_id, sentence)`` with the ordered ``array<struct<pos,token,label>>`` of each sentence.

    Rows that follow each other are gathered before the shuffle, so a sentence is a few rows there and not one per token.
    Tokens and labels are strings, positions whole numbers.
    """
    columns = ("pos", "token", "label")
    runs = rows.select("doc_id", *columns).mapInArrow(_runs, _run_schema(rows))
    gathered = runs.groupBy("doc_id").agg(F.collect_list(F.struct("first", "tokens", "labels", *columns)).alias("_runs"))
    kind = ArrayType(StructType([StructField(c, rows.schema[c].dataType) for c in columns]))

    def unpacked(r: Column) -> Column:
        place = lambda t, i, labels: F.struct((r["first"] + i).alias("pos"), t.alias("token"), F.get(labels, i).alias("label"))
        parts = let(F.split(r["labels"], MARK), lambda y: F.transform(F.split(r["tokens"], MARK), lambda t, i: place(t, i, y)))
        return F.when(r["first"].isNotNull(), parts.cast(kind)).otherwise(F.arrays_zip(*[r[c].alias(c) for c in columns]).cast(kind))

    # A sentence of one packed run is in order; nothing of it has to be compared.
    whole = (F.size("_runs") == 1) & F.get(F.col("_runs"), F.lit(0))["first"].isNotNull()
    alone = unpacked(F.get(F.col("_runs"), F.lit(0)))
    return gathered.select("doc_id", F.when(whole, alone).otherwise(F.sort_array(F.flatten(F.transform("_runs", unpacked)))).alias("sentence"))


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """Metric rows as ``write_report`` stored them."""
    return spark.read.json(
        path,
        schema="task string, candidate string, is_best boolean, label string, precision double, recall double, "
        "f1_score double, support long",
    )


def read_evaluation(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Metric rows, matrices and wrong rows as ``write_evaluation`` stored them."""
    cells = "task string, candidate string, is_best boolean, actual string, predicted string, n long"
    return (
        read_report(spark, f"{path}/metrics"),
        spark.read.schema(cells).json(f"{path}/matrices"),
        spark.read.schema("task string, text string, actual string, predicted string").json(f"{path}/errors"),
    )


def report_table(report: DataFrame) -> DataFrame:
    """Rows of the best model per task, without the accuracy row."""
    kept = report.where(F.col("is_best") & (F.col("label") != "accuracy"))
    return kept.select("task", "label", "precision", "recall", "f1_score", "support")
