"""Line de-duplication by content-defined chunks.

A document's lines are cut into chunks where a rolling hash over the hashes of
`WINDOW` lines says so, one place in `DIVISOR` on average. The hash sees only the
lines around the place, so an insertion shifts no boundary but its own. A line of
`PASSAGE_WORDS` words or more is a chunk of its own, cut on both sides; a chunk
ends after `LONGEST` lines at the latest.

Chunks of several lines with `LEAST_WORDS` words or more, and the long lines, are
counted over all documents by a 128-bit hash. Of a chunk that occurs again, the
occurrence with the smallest (id, place) stays; another one goes if its bytes are
the same as the first one's.

With `passages`, as the registered query and the pipeline ask for, no passage depends
on where a boundary falls: besides the chunks, the shortest run of `PASSAGE_WORDS`
words or more that starts at a line, and that ends at a line, is posted for every
line. Any run of so many words is made of such runs, so all of it goes if an earlier
document holds it, or the same document in an earlier place that it does not overlap.

Hashes and places alone are shuffled to find what repeats; bytes move only for
chunks that do. Counts are partial sums before the shuffle; the first occurrence is
one row joined to all others, which Spark splits if there are very many; only a
document's own repeated chunks are ever gathered.

Defined results: a null text stays null and an empty one empty; a document may be
left with an empty text but its row stays; rows that repeat id and text are one
document and change alike; null ids come first; an empty table gives no rows.
"""

import pyarrow as pa
import xxhash
from pyspark.sql import Window
from pyspark.sql import functions as F

from lexitally.session import stage_folder, stored

WINDOW = 2
DIVISOR = 2
LONGEST = 16
PASSAGE_WORDS = 50
LEAST_WORDS = 10
_MASK = (1 << 64) - 1


def line_chunks(lines, window=WINDOW, divisor=DIVISOR, longest=LONGEST, passage=PASSAGE_WORDS):
    """(start, lines, words) of every chunk, in order."""
    hashes = [xxhash.xxh64_intdigest(x) for x in lines]
    words = [len(x.split()) for x in lines]
    found, start, rolling = [], 0, 0
    out_of_window = pow(0x100000001B3, window, 1 << 64)
    for i, h in enumerate(hashes):
        rolling = (rolling * 0x100000001B3 + h) & _MASK
        if i >= window:
            rolling = (rolling - hashes[i - window] * out_of_window) & _MASK
        last = i + 1 == len(lines)
        if last or words[i] >= passage or words[i + 1] >= passage or i + 1 - start == longest or (rolling >> 33) % divisor == 0:
            found.append((start, i + 1 - start, sum(words[start : i + 1])))
            start = i + 1
    return found


def passage_runs(words, passage=PASSAGE_WORDS):
    """(start, lines) of the shortest runs of `passage` words or more from every line on, and up to every line."""
    found = set()
    end = total = 0
    for start, n in enumerate(words):
        while end < len(words) and total < passage:
            total += words[end]
            end += 1
        if total < passage:
            break
        found.add((start, end - start))
        total -= n
    start = total = 0
    for end, n in enumerate(words):
        total += n
        while total - words[start] >= passage:
            total -= words[start]
            start += 1
        if total >= passage:
            found.add((start, end + 1 - start))
    return found


def _row_key(id_col, text):
    """Names a document: a 128-bit hash of id and text."""
    part = lambda c: F.coalesce(c.cast("string"), F.lit("\u0000"))
    return F.unhex(F.md5(F.concat(part(F.col(f"`{id_col}`")), F.lit("\u0000\u0000"), part(F.col(f"`{text}`")))))


def chunk_table(docs, id_col="doc_id", text="text", least=LEAST_WORDS, passage=PASSAGE_WORDS, passages=False):
    """(row, id, start, lines, key): the chunks that count, of every document; with `passages` the runs of `passage_runs` too."""
    kind = dict(docs.dtypes)[id_col]

    def cut(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                owner, starts, sizes, keys = [], [], [], []
                for i, whole in enumerate(part.column(2).to_pylist()):
                    lines = whole.encode().split(b"\n")
                    places = {(start, n) for start, n, words in line_chunks(lines, passage=passage) if words >= passage or n > 1 and words >= least}
                    if passages:
                        places |= passage_runs([len(x.split()) for x in lines], passage)
                    for start, n in places:
                        owner.append(i)
                        starts.append(start)
                        sizes.append(n)
                        keys.append(xxhash.xxh3_128_digest(b"\n".join(lines[start : start + n])))
                owner = pa.array(owner, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(owner), part.column(1).take(owner), pa.array(starts, pa.int32()), pa.array(sizes, pa.int32()), pa.array(keys, pa.binary())],
                    ["row", "id", "start", "lines", "key"],
                )

    rows = docs.where(F.col(f"`{text}`") != "").select(_row_key(id_col, text).alias("row"), F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(cut, f"row binary, id {kind}, start int, lines int, key binary")


def suspects(chunks):
    """(row, start, lines, key, first): occurrences of chunks that occur again by their hash; first: the one that stays.

    What overlaps the first occurrence in the same document is left out.
    """
    place = F.struct("id", "row", "start")
    first = chunks.groupBy("key").agg(F.min(place).alias("_first"), F.max(place).alias("_last")).where("_first <> _last").select("key", "_first")
    is_first = place.eqNullSafe(F.col("_first"))
    apart = (F.col("row") != F.col("_first.row")) | (F.col("start") >= F.col("_first.start") + F.col("lines"))
    return chunks.join(first, "key").where(is_first | apart).select("row", "start", "lines", "key", is_first.alias("first")).distinct()


def repeated_chunks(docs, found, keep, id_col, text):
    """(row, start, lines): the suspects that are equal byte for byte to their first occurrence."""
    per_row = found.groupBy("row").agg(F.collect_list(F.struct("start", "lines", "key", "first")).alias("_found"))
    rows = docs.select(_row_key(id_col, text).alias("row"), F.col(f"`{text}`").alias("_text")).join(per_row, "row")
    lines = rows.withColumn("_lines", F.split("_text", "\n")).select("row", "_lines", F.inline("_found"))
    chunks = lines.select("row", "start", "lines", "key", "first", F.array_join(F.slice("_lines", F.col("start") + 1, F.col("lines")), "\n").alias("chunk"))
    chunks = keep(chunks.distinct(), "suspects")
    kept = chunks.where("first").select("key", F.col("chunk").alias("_first_chunk"))
    return chunks.where(~F.col("first")).join(kept, "key").where(F.col("chunk") == F.col("_first_chunk")).select("row", "start", "lines")


def merged(gone):
    """(row, start, lines): the same lines as runs that neither overlap nor touch."""
    order = Window.partitionBy("row").orderBy("start")  # a document's own repeated chunks
    end = F.col("start") + F.col("lines")
    reached = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    runs = gone.withColumn("_new", F.when(F.col("start") <= reached, 0).otherwise(1)).withColumn("_run", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy("row", "_run").agg(F.min("start").alias("start"), (F.max(end) - F.min("start")).alias("lines")).drop("_run")


def drop_repeated_lines(docs, id_col="doc_id", text="text", keep=(), **rules):
    """Every row (its columns as a struct `row`) with `text` after removal, `n_lines` and `n_removed`.

    `keep`: the input's columns to carry besides; all by default. `rules` are those of `chunk_table`.
    """
    with stage_folder(docs.sparkSession, "line-chunks") as write:
        found = write(suspects(write(chunk_table(docs, id_col, text, **rules), "chunks")), "found")
        gone = stored(repeated_chunks(docs, found, write, id_col, text), "repeated-lines")
    per_row = merged(gone).groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "lines"))).alias("_gone")).withColumnRenamed("row", "_key")
    rest = [F.col(f"`{c}`") for c in keep or docs.columns if c != text]
    rows = docs.select(F.struct(*rest).alias("_rest"), F.col(f"`{text}`").alias("_text"), _row_key(id_col, text).alias("_row"))
    joined = rows.join(per_row, F.col("_row") == F.col("_key"), "left")
    end = F.struct(F.size("_lines").alias("start"), F.lit(0).alias("lines"))
    parts = F.transform(
        F.concat("_gone", F.array(end)),
        lambda x, i: _between("_lines", F.when(i > 0, F.get("_gone", i - 1)["start"] + F.get("_gone", i - 1)["lines"]).otherwise(0), x["start"]),
    )
    names = keep or docs.columns
    row = F.struct(*[(F.col("_text") if c == text else F.col(f"_rest.`{c}`")).alias(c) for c in names])
    return joined.withColumn("_lines", F.split("_text", "\n")).select(
        row.alias("row"), F.when(F.col("_gone").isNull(), F.col("_text")).otherwise(F.array_join(F.flatten(parts), "\n")).alias("text"),
        F.coalesce(F.size("_lines"), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.aggregate("_gone", F.lit(0).cast("long"), lambda n, x: n + x["lines"]), F.lit(0)).alias("n_removed"),
    )


def _between(lines, start, end):
    return F.slice(lines, start + 1, end - start)
