"""Removing every long string that occurs again, by sorting suffixes of the texts.

A window is a string of `length` bytes inside one document. Every byte goes that
lies in a window which also starts anywhere else, in the same document or another.

1. Anchors: of the `core`-byte strings inside a window the one with the smallest hash
   (the last of equal ones) is its anchor. Equal windows have equal anchors at equal
   distances, so only windows around equal cores need comparing; about one place in
   seventy is an anchor. The windows of one anchor lie together: its zone.
2. Counting: cores that occur once are done with. Zones that occur again as a whole,
   by a 128-bit hash, go as a whole; one of them stays as a partner for others.
3. Suffix sort: the different zones around one core meet. Their bytes from the anchor
   on, and backwards from it, are sorted as suffixes (`suffix_sort`: prefix hashes,
   binary search for common extensions, mergesort, verified byte by byte). Two
   windows that start the same distance before the anchor are equal if no shorter
   extension than theirs lies between them in either order: the windows of a group are
   classed by two numbers each, no pair of zones is ever looked at.
4. A core with more than `group` different zones is cut: windows that reach far to the
   left are keyed by more bytes on the left, the others by more on the right, which
   halves the range of distances; this goes on until groups are small or a whole window
   is the key. A hot core is thus spread over tasks without losing a match.

Hashes and places alone are shuffled to find what repeats; bytes move for one
document per different zone around a repeated core, and once at the end. Long texts are
cut into overlapping pieces, which changes no window.

Defined results: a null or empty text has no bytes; a text shorter than `length` stays;
every row counts as a document, so rows that repeat id and text are copies of each
other; null ids are kept; an empty table gives no rows. What stays are bytes, which may
cut a character.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from lexitally.llm.suffix_sort import PRIME, powers, sorted_suffixes
from lexitally.session import stage_folder, stored

LENGTH = 200
CORE = 64
GROUP = 20_000
PIECE = 1 << 20


def _least(values, w):
    """Minimum of every `w` neighbouring values."""
    n = len(values)
    blocks = np.full(-(-n // w) * w, np.iinfo(np.uint64).max, np.uint64)
    blocks[:n] = values
    blocks = blocks.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - w + 1], ahead[w - 1 : n])


class Anchors:
    """Finds the anchor of every window of a text."""

    def __init__(self, length=LENGTH, core=CORE, piece=PIECE):
        self.length, self.core, self.piece = length, core, piece
        base = 0x2545F491
        self.weight, self.back = powers(base, piece + length), powers(pow(base, -1, int(PRIME)), piece + length)

    def _of(self, data, starts):
        """(anchor, first window, last window) for sorted window starts in a byte array."""
        n = len(data)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data + np.uint64(1)) * self.weight[:n] % PRIME, out=sums[1:])
        sums %= PRIME
        cores = (sums[self.core :] + PRIME - sums[: -self.core]) % PRIME * self.back[: n - self.core + 1] % PRIME
        cores = (cores * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
        last = np.uint64((1 << 32) - 1)
        least = _least((cores << np.uint64(32)) | (last - np.arange(len(cores), dtype=np.uint64)), self.length - self.core + 1)
        at = (last - (least[starts] & last)).astype(np.int64)
        new = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        return at[new], starts[new], starts[np.append(new[1:], len(at)) - 1]

    def __call__(self, texts):
        """(text, place, lo, hi, core hash, zone hash) of every anchor; windows start from hi to lo bytes before it."""
        group, size = [], 0
        for i, text in enumerate(texts):
            for at in range(0, len(text) - self.length + 1, self.piece):
                part = text[at : at + self.piece + self.length - 1]
                if group and size + len(part) > self.piece + self.length:
                    yield from self._group(group)
                    group, size = [], 0
                group.append((i, at, part))
                size += len(part)
        if group:
            yield from self._group(group)

    def _group(self, group):
        whole = b"".join(part for _, _, part in group)
        data = np.frombuffer(whole, np.uint8).astype(np.uint64)
        offsets = np.cumsum([0] + [len(part) for _, _, part in group])
        starts = np.concatenate([np.arange(o, o + len(part) - self.length + 1) for o, (_, _, part) in zip(offsets, group)])
        places, first, last = self._of(data, starts)
        owner = np.searchsorted(offsets, places, side="right") - 1
        for g, p, s, e in zip(owner.tolist(), places.tolist(), first.tolist(), last.tolist()):
            i, at, _ = group[g]
            core = xxhash.xxh3_64_intdigest(whole[p : p + self.core])
            yield i, p - int(offsets[g]) + at, p - e, p - s, core, xxhash.xxh3_128_digest(whole[s : e + self.length], seed=p - s)


class Zones:
    """The windows of zones around one core that occur again in the group."""

    def __init__(self, length=LENGTH, core=CORE):
        self.length, self.span = length, length - core

    def _suffixes(self, parts, most):
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        rows = np.zeros((len(parts), most), np.uint8)
        flat = np.frombuffer(b"".join(parts), np.uint8)
        at = np.repeat(np.cumsum(sizes) - sizes, sizes)
        rows[np.repeat(np.arange(len(parts)), sizes), np.arange(len(flat)) - at] = flat
        return rows, sizes

    def repeated(self, groups, lo, hi, parts):
        """(zone, distance) -> whether the window that starts so far before the zone's anchor occurs again.

        groups: numbers, equal ones together; parts: the bytes from hi before the anchor to the end of the last window.
        """
        n = len(parts)
        order, shared, sizes = {}, {}, {}
        cut = hi.tolist()
        for side, halves in (("right", [x[h:] for h, x in zip(cut, parts)]), ("left", [x[:h][::-1] for h, x in zip(cut, parts)])):
            rows, sizes[side] = self._suffixes(halves, self.length if side == "right" else max(1, self.span))
            order[side], shared[side] = sorted_suffixes(rows, sizes[side], groups)
        found = np.zeros((n, self.span + 1), bool)
        for distance in range(self.span + 1):
            takes_part = np.flatnonzero((lo <= distance) & (distance <= hi))
            if len(takes_part) < 2:
                continue
            classes = []
            for side, reach in (("right", self.length - distance), ("left", distance)):
                number = np.empty(n, np.int64)
                number[order[side]] = np.cumsum(shared[side] < reach)
                classes.append(number[takes_part])
            key = classes[0] * np.int64(n + 1) + classes[1]
            by_key = np.argsort(key, kind="stable")
            same = key[by_key][1:] == key[by_key][:-1]
            again = np.concatenate([[False], same]) | np.concatenate([same, [False]])
            found[takes_part[by_key[again]], distance] = True
        return found

    def spans(self, batches, most):
        """(row, start, end) of what repeats, from batches of zones (g, row, place, lo, hi, whole, bytes) sorted by g."""
        held, n = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            n += batch.num_rows
            if n >= most:
                table = pa.Table.from_batches(held)
                keys = table.column("g")
                end = n
                last = keys[n - 1].as_py()
                names = keys.to_pylist()
                while end and names[end - 1] == last:
                    end -= 1
                if end:
                    yield from self._spans(table.slice(0, end))
                    held, n = table.slice(end).to_batches(), n - end
        if held:
            yield from self._spans(pa.Table.from_batches(held))

    def _spans(self, table):
        table = table.combine_chunks()
        groups = table.column("g").combine_chunks().dictionary_encode().indices.to_numpy()
        lo, hi, place = (table.column(c).to_numpy().astype(np.int64) for c in ("lo", "hi", "place"))
        whole = table.column("whole").to_numpy()
        found = self.repeated(groups, lo, hi, table.column("bytes").to_pylist())
        found[whole] = False  # known already
        edge = np.diff(np.pad(found, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        zone, near = np.nonzero(edge == 1)
        far = np.nonzero(edge == -1)[1] - 1
        starts, ends = place[zone] - far, place[zone] - near + self.length
        yield pa.RecordBatch.from_arrays(
            [table.column("row").combine_chunks().take(pa.array(zone)), pa.array(starts), pa.array(ends)], ["row", "start", "end"]
        )


def _row_key(id_col, text):
    """Names a document: a 128-bit hash of id and text. Repeated rows share it, and change alike."""
    part = lambda c: F.coalesce(c.cast("string"), F.lit("\u0000"))
    return F.unhex(F.md5(F.concat(part(F.col(f"`{id_col}`")), F.lit("\u0000\u0000"), part(F.col(f"`{text}`")))))


def anchor_table(docs, id_col, text, length, core):
    """(row, place, lo, hi, a, z): every anchor, with the hashes of its core and its zone."""
    schema = "row binary, place long, lo int, hi int, a long, z binary"

    def found(batches):
        find = Anchors(length, core)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                columns = list(zip(*find(part.column(1).to_pylist()))) or [[]] * 6
                owner, place, lo, hi, a, z = columns
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(owner, pa.int32())), pa.array(place, pa.int64()), pa.array(lo, pa.int32()), pa.array(hi, pa.int32()),
                     pa.array(np.array(a, np.uint64).view(np.int64)), pa.array(z, pa.binary())],
                    ["row", "place", "lo", "hi", "a", "z"],
                )

    rows = docs.where(F.octet_length(f"`{text}`") >= length).select(_row_key(id_col, text).alias("row"), F.col(f"`{text}`").cast("binary").alias("text"))
    return rows.mapInArrow(found, schema)


def _spans_of(zones, length):
    return zones.select("row", (F.col("place") - F.col("hi")).alias("start"), (F.col("place") - F.col("lo") + length).alias("end"))


def _halves(zones, length):
    """Zones of large groups by a longer key: each goes to the group of its far windows and to that of its near ones."""
    middle = F.floor((F.col("f") + F.col("t")) / 2).cast("int")
    near = F.struct(F.col("f").alias("f"), middle.alias("t"))
    far = F.struct((middle + 1).alias("f"), F.col("t").alias("t"))
    cut = zones.select("*", F.explode(F.array(near, far)).alias("_half")).withColumns(
        {"f": F.col("_half.f"), "t": F.col("_half.t"), "_lo": F.greatest("lo", "_half.f"), "_hi": F.least("hi", "_half.t")}
    ).where("_lo <= _hi")
    bytes_from = lambda before, size: F.substr("bytes", F.col("hi") - before + 1, size)
    key = F.unhex(F.md5(F.concat("g", F.concat(F.col("f"), F.lit("-"), F.col("t")).cast("binary"), bytes_from(F.col("f"), F.col("f") + length - F.col("t")))))
    part = bytes_from(F.col("_hi"), F.col("_hi") - F.col("_lo") + length)
    return cut.select(
        key.alias("g"), "f", "t", "row", "place", F.col("_lo").alias("lo"), F.col("_hi").alias("hi"), "whole", part.alias("bytes"),
    ).withColumn("z", F.unhex(F.md5(F.concat("bytes", F.col("hi").cast("string").cast("binary")))))


def repeated_spans(docs, keep, id_col="doc_id", text="text", length=LENGTH, core=CORE, group=GROUP):
    """(row, start, end): byte ranges that cover all of what repeats, of all documents; a list of tables."""
    anchors = keep(anchor_table(docs, id_col, text, length, core), "anchors")
    again = anchors.groupBy("a").agg(F.count("*").alias("n")).where("n > 1").select("a")
    anchors = keep(anchors.join(again, "a"), "repeated-cores")
    zones = keep(anchors.groupBy("z").agg(F.count("*").alias("n"), F.first("a").alias("a"), F.min(F.struct("row", "place", "lo", "hi")).alias("one")), "zones")
    found = [_spans_of(anchors.join(zones.where("n > 1").select("z"), "z"), length)]
    groups = zones.groupBy("a").agg(F.count("*").alias("d")).where("d > 1")
    ones = keep(zones.join(groups, "a").select("a", "d", (F.col("n") > 1).alias("whole"), "one.*"), "partners")
    per_row = ones.groupBy("row").agg(F.collect_list(F.struct("a", "d", "whole", "place", "lo", "hi")).alias("_zones"))  # a document's own
    texts = docs.select(_row_key(id_col, text).alias("row"), F.col(f"`{text}`").cast("binary").alias("_text")).join(per_row, "row")
    texts = texts.select("row", "_text", F.inline("_zones"))
    current = texts.select(
        F.hex("a").cast("binary").alias("g"), F.lit(0).alias("f"), F.lit(length - core).alias("t"), "row", "place", "lo", "hi", "whole", "d",
        F.substr("_text", (F.col("place") - F.col("hi") + 1).cast("int"), F.col("hi") - F.col("lo") + length).alias("bytes"),
    ).dropDuplicates(["row", "place", "lo", "hi"])  # rows that repeat id and text
    current = keep(current, "zone-bytes-0")
    columns = ["g", "row", "place", "lo", "hi", "whole", "bytes"]
    finder = Zones(length, core)
    level = 0
    while True:
        small = current.where(F.col("d") <= group).select(*columns)
        sort = small.repartition("g").sortWithinPartitions("g").mapInArrow(lambda batches: finder.spans(batches, group), "row binary, start long, end long")
        found.append(keep(sort, f"sorted-{level}"))
        large = current.where(F.col("d") > group)
        if large.isEmpty():
            return found
        level += 1
        cut = keep(_halves(large, length), f"cut-{level}")
        place = F.struct("row", "place", "lo", "hi")
        same = keep(cut.groupBy("g", "z").agg(F.count("*").alias("n"), F.min(place).alias("_one"), F.max("whole").alias("_whole")), f"same-{level}")
        copies = cut.join(same.where("n > 1").select("g", "z"), ["g", "z"])
        found.append(_spans_of(copies.where(~F.col("whole")), length))
        sizes = same.groupBy("g").agg(F.count("*").alias("d")).where("d > 1")
        kept = same.join(sizes, "g").select("g", "d", "_one.*", ((F.col("n") > 1) | F.col("_whole")).alias("_whole"))
        current = cut.drop("whole").join(kept, ["g", "row", "place", "lo", "hi"]).withColumnRenamed("_whole", "whole")
        current = keep(current.select("g", "f", "t", "row", "place", "lo", "hi", "whole", "d", "bytes"), f"zone-bytes-{level}")


def remove_repeats(docs, id_col="doc_id", text="text", length=LENGTH, core=CORE, group=GROUP):
    """Every row's id with `kept` (binary: the bytes that stay), `n_bytes` and `removed` (array of start and end of the runs removed)."""
    kind = dict(docs.dtypes)[id_col]
    with stage_folder(docs.sparkSession, "suffix-repeats") as keep:
        spans = repeated_spans(docs, keep, id_col, text, length, core, group)
        gone = spans[0]
        for other in spans[1:]:
            gone = gone.unionByName(other)
        gone = stored(gone.groupBy("row").agg(F.collect_list(F.struct("start", "end")).alias("spans")), "repeated-spans")  # a document's own
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("text"), _row_key(id_col, text).alias("row"))

    def cut(batches):
        for batch in batches:
            runs, kept = [], []
            for whole, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                merged = []
                for span in sorted((s["start"], s["end"]) for s in spans or ()):
                    if merged and span[0] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], span[1])
                    else:
                        merged.append(list(span))
                runs.append([{"start": s, "end": e} for s, e in merged])
                edges = [0, *(x for run in merged for x in run), len(whole)]
                kept.append(b"".join(whole[s:e] for s, e in zip(edges[::2], edges[1::2])))
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(kept, pa.binary()), pa.array([len(x) for x in batch.column(1).to_pylist()], pa.int64()), pa.array(runs, span)],
                ["id", "kept", "n_bytes", "removed"],
            )

    joined = rows.join(gone, "row", "left").select("id", "text", "spans")
    return joined.mapInArrow(cut, f"id {kind}, kept binary, n_bytes long, removed array<struct<start:bigint,end:bigint>>").withColumnRenamed("id", id_col)
