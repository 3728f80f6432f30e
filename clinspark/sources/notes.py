"""Free-text notes: one file per patient, many dated notes per file."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from clinspark.functions.dates import parse_strict_date

# The file-name pattern, the note pattern and the end of a note. With flag d only the
# line feed ends a line; with flag s the body runs over line ends.
PATIENT_PATTERN = r"(^.*_)(.*?).txt"
DATE_PATTERN = r"[1-2][0-9]{3}-[0-9]{2}-[0-9]{2}"
NOTE_PATTERN = r"(?d)[1-2][0-9]{3}-[0-9]{2}-[0-9]{2}.*\n\n(?s:.*?)\n\n\n\n"
NOTE_END = "\n\n\n\n"
HEADER_END = "\n\n"
#: Folders that hold the patients' folders, at least: Spark lists each in a task of its own, not each patient's.
FOLDERS = 256
#: What one task writes.
FILES_PER_TASK = 250
NOTES_PER_TASK = 100_000
#: Files up to this size (and a block's) are read whole, and so many by one task.
WHOLE_BYTES = 1 << 20
WHOLE_PER_TASK = 64


@dataclass(frozen=True)
class Notes:
    """Parsed notes, and what could not be used with the reason."""

    rows: DataFrame
    rejects: DataFrame


def patient_of_file(file_name: Column | str, pattern: str = PATIENT_PATTERN, group: int = 2) -> Column:
    """Patient id in a file name: the text behind the last underscore. Null when there is none."""
    file_name = F.col(file_name) if isinstance(file_name, str) else file_name
    return F.when(file_name.rlike(pattern), F.regexp_extract(file_name, pattern, group))


def _found_notes(text: Column, keep_unterminated: bool) -> Column:
    """All notes of a document, whole, as an array."""
    plain = F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    if keep_unterminated:
        plain = F.concat(plain, F.lit(NOTE_END))
    return F.regexp_extract_all(plain, F.lit(NOTE_PATTERN), F.lit(0))


def _header(note: str) -> Column:
    # A header is one line, so the first blank line of a note is the end of its header.
    return F.substring_index(note, HEADER_END, 1)


def _body(note: str) -> Column:
    begin = F.length(_header(note)) + len(HEADER_END) + 1
    return F.substr(note, begin, F.length(note) - begin + 1 - len(NOTE_END))


def segment_notes(docs: DataFrame, *, text: str = "text", keep_unterminated: bool = False) -> DataFrame:
    """One row per note of every document: the header line as ``header`` and the ``note_text``.

    A note is a line that begins with a date, a blank line, a body that may hold blank lines, and
    four line ends. A last note without them is left out unless ``keep_unterminated``.
    """
    others = [c for c in docs.columns if c != text]
    found = docs.select(*others, F.explode(_found_notes(F.col(text), keep_unterminated)).alias("_note"))
    return found.select(*others, _header("_note").alias("header"), _body("_note").alias("note_text"))


def note_chunks(
    spark: SparkSession, path: str, *, keep_unterminated: bool = False, only: Column | None = None
) -> DataFrame:
    """``file, name, text``: the files of a folder in chunks that hold whole notes only, from any number of blocks a file.

    Files are read line by line, so a file is as many tasks as it has blocks. A line without a date and three blank lines
    behind it end whatever note is open, and no note begins in them: there a file can be cut without knowing what stands
    before. A task cuts its own blocks; what lies before a block's first cut and behind its last one is put together
    with its neighbours, two pieces a block at most. A chunk is as long as its notes, and longer only where bodies
    end with a date. Line ends of any kind count as one line feed. ``only`` is a condition on ``_metadata`` that files meet.
    """
    source = spark.read.option("recursiveFileLookup", True).text(path)
    lines = (source if only is None else source.where(only)).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_name").alias("name"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    block = Window.partitionBy("file", "block").orderBy("row")
    blank = F.col("value") == ""
    behind = [F.lead(blank, i, False).over(block) for i in range(1, len(NOTE_END))]
    cut = ~blank & ~F.col("value").rlike(DATE_PATTERN) & behind[0] & behind[1] & behind[2]
    # A cut lies behind the blank lines, so it counts for the rows from there on.
    chunk = F.coalesce(F.sum("cut").over(block.rowsBetween(Window.unboundedPreceding, -len(NOTE_END))), F.lit(0))
    pieces = lines.withColumn("cut", cut.cast("int")).withColumn("chunk", chunk).groupBy("file", "name", "block", "chunk").agg(
        (F.max("cut") == 1).alias("closed"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("row", "value"))), lambda x: x["value"]), "\n").alias("text"))
    # Known from its own block alone: begins behind a cut or with its file, and ends with a cut.
    whole = F.col("closed") & ((F.col("chunk") > 0) | (F.col("block") == 0))
    order = Window.partitionBy("file").orderBy("block", "chunk")
    seams = pieces.where(~whole).withColumn(
        "seam", F.coalesce(F.sum(F.col("closed").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    # A whole chunk between two open ones parts them, too: the piece behind it is no first one.
    seams = seams.withColumn("seam", F.struct("seam", F.sum(F.when(F.col("chunk") > 0, 1).otherwise(0)).over(
        order.rowsBetween(Window.unboundedPreceding, 0))))
    joined = seams.groupBy("file", "name", "seam").agg(
        F.sort_array(F.collect_list(F.struct("block", "chunk", "text", "closed"))).alias("pieces"))
    text = F.array_join(F.transform("pieces", lambda x: x["text"]), "\n")
    if keep_unterminated:
        # What no cut ends lies at the end of its file.
        text = F.concat(text, F.when(F.element_at("pieces", -1)["closed"], "").otherwise(NOTE_END))
    chunks = pieces.where(whole).select("file", "name", "text").unionByName(joined.select("file", "name", text.alias("text")))
    return chunks.withColumn("text", F.concat("text", F.lit("\n")))


def read_notes(
    spark: SparkSession,
    path: str,
    *,
    pattern: str = PATIENT_PATTERN,
    group: int = 2,
    match_path: bool = False,
    keep_unterminated: bool = False,
    observation: Observation | None = None,
) -> Notes:
    """All note files of a folder in one distributed scan, as (date, note_text, patient).

    The patient id comes from the file name (or, with ``match_path``, from the whole path). Files without an id (in
    their chunks, see ``note_chunks``) and notes whose header is more than a date go to ``rejects``. An ``observation``
    learns ``n_rejected`` from the first job that reads ``rows``.

    Small text files with an id are read whole, ``WHOLE_PER_TASK`` in a task. Each is a row that is shuffled once, so that the
    tasks behind are as many as the bytes need. All others are read by lines and blocks, and listed once more if there are any.
    """

    def patient(file: str, name: str) -> Column:
        return patient_of_file(F.col(file if match_path else name), pattern, group)

    stored = spark.read.option("recursiveFileLookup", True).format("binaryFile").load(path)
    most = min(WHOLE_BYTES, spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    # A condition on metadata alone chooses files before any is opened. By its name a file may be compressed: not so .txt.
    whole = (
        (F.col("_metadata.file_size") <= most) & F.col("_metadata.file_name").endswith(".txt")
        & patient("_metadata.file_path", "_metadata.file_name").isNotNull())
    tasks = -(-len(stored._jdf.inputFiles()) // WHOLE_PER_TASK)  # the names stay in the JVM
    files = (
        stored.where(whole).coalesce(max(1, tasks)).select(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_name").alias("name"), F.col("content").cast("string").alias("text"))
        .hint("rebalance", "file")
        .select("file", "name", F.concat("text", F.lit(NOTE_END)).alias("text") if keep_unterminated else "text")
    )
    if not stored.where(~whole).isEmpty():
        files = files.unionByName(note_chunks(spark, path, keep_unterminated=keep_unterminated, only=~whole))
    files = files.select("text", "file", patient("file", "name").alias("patient"))
    unnamed = F.col("patient").isNull()
    # What has no id is handed on as it is, so that one scan finds both kinds of rejects.
    parts = F.when(unnamed, F.array("text")).otherwise(_found_notes(F.col("text"), False))
    notes = (
        files.select("file", "patient", F.explode(parts).alias("_note"))
        .select(
            "file", "patient",
            F.when(~unnamed, _header("_note")).alias("header"),
            F.when(unnamed, F.col("_note")).otherwise(_body("_note")).alias("note_text"),
        )
        .withColumn("date", parse_strict_date("header"))
        .withColumn(
            "reason",
            F.when(unnamed, "no patient id in the file name").when(F.col("date").isNull(), "header is not a date"),
        )
    )
    if observation:
        notes = notes.observe(observation, F.count("reason").alias("n_rejected"))
    return Notes(
        notes.where(F.col("reason").isNull()).select("date", "note_text", "patient"),
        notes.where(F.col("reason").isNotNull()).select("file", "reason", "header", "note_text"),
    )


def write_notes(
    df: DataFrame,
    path: str,
    *,
    patient: str = "patient",
    date: str = "date",
    note_text: str = "note_text",
    max_notes_per_file: int = 10_000,
) -> None:
    """Write notes in the note format, under one folder per patient; patients' folders lie in ``FOLDERS`` others.

    A patient's notes are brought together to keep the number of files low, and streamed to them: no
    document is put together in memory. A patient with very many notes is spread over several tasks
    by a hash of the notes, and over several files of a bounded size. Tasks are as many as the files and the
    notes need, not their bytes, since a small file costs as much as a larger one. Each has whole folders, all but the
    further parts of such patients, so that a folder is made once and moved to its place as one; with more tasks than
    ``FOLDERS`` there are as many folders as tasks.
    """
    note = F.concat(F.date_format(date, "yyyy-MM-dd"), F.lit("\n\n"), F.col(note_text))
    rows = df.select(F.col(patient).cast("string").alias("patient"), note.alias("value"))
    counts = rows.groupBy("patient").agg(F.count("*").alias("n"))
    files, total, most = counts.agg(F.sum(F.ceil(F.col("n") / max_notes_per_file)), F.sum("n"), F.max("n")).first()
    tasks = max(1, (files or 0) // FILES_PER_TASK, (total or 0) // NOTES_PER_TASK)
    folders = max(FOLDERS, tasks)
    folders_per_task = folders // tasks
    part = F.lit(0)
    if (most or 0) > max_notes_per_file:
        many = counts.where(F.col("n") > max_notes_per_file).select(
            F.col("patient").alias("_patient"), F.ceil(F.col("n") / max_notes_per_file).alias("parts"))
        rows = rows.join(many, F.col("patient").eqNullSafe(F.col("_patient")), "left")
        part = F.coalesce(F.pmod(F.xxhash64("value"), F.col("parts")), F.lit(0))
    placed = rows.select("value", F.pmod(F.xxhash64("patient"), F.lit(folders)).alias("folder"), "patient", part.alias("part"))
    (
        # Ids beyond the last task begin with the first one again.
        placed.repartitionById(-(-folders // folders_per_task), (F.floor(F.col("folder") / folders_per_task) + F.col("part")).cast("int"))
        .select("value", "folder", "patient")
        .write.mode("overwrite")
        .option("lineSep", NOTE_END)
        .option("maxRecordsPerFile", max_notes_per_file)
        .partitionBy("folder", "patient")
        .text(path)
    )


#: Patient id in the folders ``write_notes`` makes (use with ``match_path`` and group 1).
PATIENT_FOLDER_PATTERN = r"/patient=([^/]+)/[^/]+$"
