"""Suffix-array deduplication: every 100 bytes that also stand earlier in the corpus go.

The corpus is far too large for one suffix array, and needs none: only stretches that may be
repeated have to be sorted. They are found and dealt out so that equal windows of 100 bytes
always meet:

1. Each window has an anchor, its 32 bytes of smallest hash (the first of equals). Equal
   windows have equal anchors at equal places. Neighbouring windows mostly share theirs, so
   a text is a sequence of runs of windows with one anchor, a run every 35 bytes or so.
2. Runs whose anchor occurs only once in the corpus are out.
3. Equal runs (same anchor, same bytes around it) are a class. All of its members but the
   earliest are repeated as a whole, so only the earliest goes on; a text with thousands of
   copies is handled once.
4. Windows that two different runs share are left. Runs that are the only class of their
   anchor have none. The others are cut into cells, the windows with their anchor at one of
   17 neighbouring places; all windows of a cell share 84 bytes, and cells meet by the hash
   of these. Cells whose 84 bytes are unique are out.
5. What is left is dealt to groups by that hash. Within a group, cells are trimmed to the
   windows whose hash occurs twice, and of equal stretches that are left the earliest goes on,
   if another one still shares a window with it. These are joined to one text, its suffixes
   are sorted by linear grouping (see ``suffixes``), and suffixes that agree in 100 bytes are
   neighbours then: all but the earliest are repeated.
6. Cells of one core that would be more than a group by themselves, such as those of a short
   passage that very many documents have in other surroundings, go to no task as a whole:
   their windows are rows, and equal ones are grouped by their bytes.

Repeated windows are merged per document and cut out. Candidates are found by hashes of 64
bits; equal windows cannot be missed, and what is removed in steps 5 and 6 has been compared
byte by byte.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitledger.llm import batches
from hitledger.llm.frames import stored, without
from hitledger.llm.suffixes import suffix_array

WINDOW = 100
ANCHOR = 32
# Windows have WINDOW - ANCHOR + 1 = 69 places for an anchor.
PLACES = WINDOW - ANCHOR + 1
# Neighbouring places of an anchor that share a cell.
CELL = 17
# Bytes that a group's suffix array is meant to have.
GROUP_BYTES = 1 << 16

ADDED = ("n_bytes", "n_removed", "n_spans", "kept_sha256")


def runs(data: np.ndarray, offsets: np.ndarray):
    """For every run of windows: its row, first window (a byte of the slice), number of
    windows, place of the anchor after the first window, and the anchor's hash; besides
    these the sums for hashes of other stretches."""
    sums = batches.prefix_sums(batches.PLAIN[data])
    count = len(data) - WINDOW + 1
    none = np.zeros(0, np.int64)
    if count < 1:
        return none, none, none, none, np.zeros(0, np.uint64), sums
    starts = np.arange(len(data) - ANCHOR + 1)
    hashes = batches.mix(batches.stretch_hash(sums, starts, starts + ANCHOR))
    # The smallest hash, and of equals the first: hash above, place below.
    keys = (hashes & np.uint64(0xFFFFFFFF00000000)) | starts.astype(np.uint64)
    least, width = keys, 1
    while 2 * width <= PLACES:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = PLACES - width
    least = np.minimum(least[: len(least) - rest], least[rest:]) if rest else least
    anchor = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    inside = row[:count] == row[WINDOW - 1 :]
    first = inside.copy()
    first[1:] &= ~inside[:-1] | (anchor[1:] != anchor[:-1])
    begin = np.flatnonzero(first)
    stop = first.copy()
    stop[:-1] = inside[:-1] & (first[1:] | ~inside[1:])
    stop[-1] = inside[-1]
    n = np.flatnonzero(stop) - begin + 1
    return row[begin], begin, n, anchor[begin] - begin, hashes[anchor[begin]], sums


def _anchors(batch):
    parts = [runs(data, offsets)[4] for _, _, data, offsets in batches.slices(batch.column("text"))]
    if parts:
        found, n = np.unique(np.concatenate(parts), return_counts=True)
        yield pa.record_batch([pa.array(batches.signed(found)), pa.array(n)], ["anchor", "n"])


def _runs(batch):
    for first, _, data, offsets in batches.slices(batch.column("text")):
        row, begin, n, shift, anchor, sums = runs(data, offsets)
        whole = batches.stretch_hash(sums, begin, begin + n - 1 + WINDOW)
        of_class = batches.mix(whole + (n * 256 + shift).astype(np.uint64))
        place = (begin - offsets[row]) << 16 | n << 8 | shift
        at = pa.array(first + row)
        yield pa.record_batch(
            [pa.array(batches.signed(anchor)), pa.array(batches.signed(of_class)), batch.column("id").take(at),
             batch.column("key").take(at), pa.array(place)],
            ["anchor", "class", "id", "key", "place"],
        )


def _cells(rows: pa.RecordBatch):
    """The cells of the given runs, with their bytes."""
    for first, last, data, offsets in batches.slices(rows.column("text")):
        sums = batches.prefix_sums(batches.PLAIN[data])
        out = []
        for r, places in enumerate(rows.column("places").slice(first, last - first).to_pylist()):
            for place in places:
                begin, n, shift = place >> 16, place >> 8 & 255, place & 255
                anchor = begin + shift
                # The anchor is ``shift`` bytes into the first window, less into later ones.
                for cell in range((shift - n + 1) // CELL, shift // CELL + 1):
                    most, fewest = min(shift, cell * CELL + CELL - 1), max(shift - n + 1, cell * CELL)
                    out.append((r, anchor - most, anchor - fewest + WINDOW, anchor - cell * CELL, anchor - cell * CELL - CELL + 1 + WINDOW))
        if not out:
            continue
        row, begin, end, core, core_end = np.array(out, np.int64).T
        base = offsets[row]
        hashes = batches.mix(batches.stretch_hash(sums, base + core, base + core_end))
        pieces = [data[a:b].tobytes() for a, b in zip(base + begin, base + end, strict=True)]
        at = pa.array(first + row)
        yield pa.record_batch(
            [pa.array(batches.signed(hashes)), rows.column("id").take(at), rows.column("key").take(at), pa.array(begin), pa.array(pieces, pa.binary())],
            ["core", "id", "key", "begin", "piece"],
        )


def repeated_windows(pieces: list[bytes]) -> list[tuple[int, int]]:
    """Of pieces in the order of the corpus, the windows (piece, place) that an earlier piece
    has as well, or the same piece earlier; by the suffix array of all of them."""
    values: list[int] = []
    ends, owners = [], []
    for number, piece in enumerate(pieces):
        values += piece
        ends += [len(values)] * len(piece) + [0]
        owners += [number] * (len(piece) + 1)
        values.append(-1)
    text = b"".join(piece + b"\0" for piece in pieces)
    found, before, earliest = [], None, 0
    for place in suffix_array(values):
        if ends[place] - place < WINDOW:
            continue
        window = text[place : place + WINDOW]
        if window != before:
            before, earliest = window, place
        elif place < earliest:
            found.append(earliest)
            earliest = place
        else:
            found.append(place)
    starts = np.concatenate([[0], np.cumsum([len(piece) + 1 for piece in pieces])])
    return [(owners[place], int(place - starts[owners[place]])) for place in found]


def trimmed(pieces: list[bytes]) -> list[tuple[int, int, bytes]]:
    """The stretches (piece, place, bytes) of windows whose hash other windows have, too."""
    data = np.frombuffer(b"".join(pieces), np.uint8)
    ends = np.cumsum(np.array([len(piece) for piece in pieces], np.int64))
    owner = np.repeat(np.arange(len(pieces)), np.diff(ends, prepend=0))
    count = len(data) - WINDOW + 1
    if count < 1:
        return []
    inside = np.flatnonzero(owner[:count] == owner[WINDOW - 1 :])
    sums = batches.prefix_sums(batches.PLAIN[data])
    _, same, n = np.unique(batches.mix(batches.stretch_hash(sums, inside, inside + WINDOW)), return_inverse=True, return_counts=True)
    at = inside[n[same] > 1]
    first = np.ones(len(at), bool)
    first[1:] = (np.diff(at) > 1) | (owner[at[1:]] != owner[at[:-1]])
    last = np.roll(first, -1)
    starts = ends - np.diff(ends, prepend=0)
    return [
        (int(owner[a]), int(a - starts[owner[a]]), data[a : b + WINDOW].tobytes())
        for a, b in zip(at[first], at[last], strict=True)
    ]


def repeated_stretches_of(pieces: list[bytes]) -> list[tuple[int, int, int]]:
    """Of pieces in the order of the corpus, the stretches (piece, begin, end) of windows that
    come earlier as well."""
    found, firsts = [], {}
    for number, place, said in trimmed(pieces):
        if said in firsts:
            found.append((number, place, place + len(said)))
        else:
            firsts[said] = number, place
    # What still shares a window with another one, or with itself, is sorted.
    left = list(firsts)
    sharing = sorted({number for number, _, _ in trimmed(left)})
    for k, place in repeated_windows([left[number] for number in sharing]):
        number, begin = firsts[left[sharing[k]]]
        found.append((number, begin + place, begin + place + WINDOW))
    return found


def _sorted_group(table: pa.Table) -> pa.Table:
    """The repeated windows of a group of cells, as stretches of their documents."""
    rows = sorted(table.to_pylist(), key=lambda r: (r["id"] is not None, r["id"], r["key"], r["begin"], len(r["piece"])))
    # Rows alike in id and text bring the same cells.
    rows = [r for k, r in enumerate(rows) if not k or r != rows[k - 1]]
    stretches: dict[tuple, list[tuple[int, int]]] = {}
    for number, begin, end in repeated_stretches_of([r["piece"] for r in rows]):
        row = rows[number]
        stretches.setdefault((row["id"], row["key"]), []).append((row["begin"] + begin, row["begin"] + end))
    out = [(*of, begin, end) for of, found in stretches.items() for begin, end in merged(found)]
    kind = pa.schema([table.schema.field("id"), ("key", pa.int64()), ("begin", pa.int64()), ("end", pa.int64())])
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out), kind)] if out else [pa.array([], f.type) for f in kind], schema=kind)


def merged(stretches) -> list[tuple[int, int]]:
    """Stretches in order, those that touch or overlap as one."""
    out: list[tuple[int, int]] = []
    for begin, end in sorted(stretches):
        if out and begin <= out[-1][1]:
            out[-1] = out[-1][0], max(end, out[-1][1])
        else:
            out.append((begin, end))
    return out


def _cut(column: pa.Array, stretches: pa.Array):
    data, offsets = batches.bytes_of(column)
    for r, found in enumerate(stretches.to_pylist()):
        text = data[offsets[r] : offsets[r + 1]]
        keep = np.ones(len(text), bool)
        gone = merged((s["begin"], s["end"]) for s in found or ())
        for begin, end in gone:
            keep[begin:end] = False
        yield len(text), len(text) - int(keep.sum()), len(gone), text[keep].tobytes()


def repeated_stretches(documents: DataFrame) -> DataFrame:
    """``id``, ``key``, ``begin``, ``end`` (bytes) of what is repeated, from documents of
    ``id``, ``key`` and ``text``; stretches may overlap."""
    id_type = dict(documents.dtypes)["id"]
    # Written before they are joined, so that a hot key's rows can be split.
    anchors = batches.map_batches(documents.select("text"), _anchors, "anchor bigint, n bigint")
    several = stored(anchors.groupBy("anchor").agg(F.sum("n").alias("n")).filter("n > 1").select("anchor"), "several")
    found = batches.map_batches(
        documents, _runs, f"anchor bigint, class bigint, id {id_type}, key bigint, place bigint"
    )
    found = stored(found.join(several, "anchor"), "runs")

    # The earliest of each class. Copies of a run are one row per task before the exchange.
    here = F.struct("id", "key", F.shiftright("place", 16).alias("begin"))
    classes = found.groupBy("anchor", "class").agg(F.min(here).alias("first"), F.first("place").alias("place"))
    classes = stored(classes, "classes")
    begin, n = F.shiftright("place", 16), F.shiftright("place", 8).bitwiseAND(F.lit(255))
    copies = (
        found.join(classes.select("anchor", "class", "first"), ["anchor", "class"])
        .filter(~here.eqNullSafe(F.col("first")))
        .select("id", "key", begin.alias("begin"), (begin + n - 1 + WINDOW).alias("end"))
    )
    mixed = stored(classes.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor"), "mixed")
    own = F.col("place").bitwiseAND(F.lit(65535))
    leaders = classes.join(mixed, "anchor").select(
        "first.id", "first.key", F.shiftleft("first.begin", 16).bitwiseOR(own).alias("place")
    )
    places = leaders.groupBy("id", "key").agg(F.collect_set("place").alias("places"))
    texts = _with(documents, places).select("id", "key", "text", "places")
    cells = batches.map_batches(
        texts.filter("places is not null"), _cells, f"core bigint, id {id_type}, key bigint, begin bigint, piece binary"
    )
    cells = stored(cells, "cells")
    size = F.sum(F.octet_length("piece")).alias("size")
    shared = stored(cells.groupBy("core").agg(size, F.count("*").alias("n")).filter("n > 1").drop("n"), "cores")
    cells = stored(cells.join(shared, "core"), "shared")
    few = cells.filter(F.col("size") <= GROUP_BYTES)
    groups = (few.agg(F.sum(F.octet_length("piece"))).first()[0] or 0) // GROUP_BYTES + 1
    batches.importable(cells)
    sorted_ = (
        few.withColumn("group", F.pmod("core", F.lit(groups)))
        .select("group", "id", "key", "begin", "piece")
        .groupBy("group")
        .applyInArrow(_sorted_group, f"id {id_type}, key bigint, begin bigint, end bigint")
    )
    return copies.unionByName(sorted_).unionByName(_repeated_as_rows(cells.filter(F.col("size") > GROUP_BYTES)))


def _repeated_as_rows(cells: DataFrame) -> DataFrame:
    """Windows of cells that an earlier one has as well, grouped by their bytes."""
    places = F.explode(F.sequence(F.lit(0), (F.octet_length("piece") - WINDOW).cast("int"))).alias("place")
    windows = cells.select("id", "key", "begin", "piece", places)
    said = F.substring("piece", F.col("place") + 1, F.lit(WINDOW)).alias("window")
    windows = stored(windows.select("id", "key", (F.col("begin") + F.col("place")).alias("begin"), said), "hot_windows")
    here = F.struct("id", "key", "begin")
    earliest = windows.groupBy("window").agg(F.min(here).alias("first"), F.count("*").alias("n")).filter("n > 1")
    later = windows.join(stored(earliest.select("window", "first"), "hot_earliest"), "window")
    return later.filter(~here.eqNullSafe(F.col("first"))).select("id", "key", "begin", (F.col("begin") + WINDOW).alias("end"))


def _with(documents: DataFrame, found: DataFrame) -> DataFrame:
    """Documents with what was found for their id and key; ids may be null."""
    other = found.withColumnsRenamed({"id": "__id", "key": "__key"})
    same = (F.col("key") == F.col("__key")) & F.col("id").eqNullSafe(F.col("__id"))
    return documents.join(other, same, "left").drop("__id", "__key")


def remove_repeats(documents: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Adds to every document ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed
    stretches), ``kept_sha256`` and ``kept_bytes`` (what is left, joined).

    Removed is each byte of a stretch of 100 bytes that also starts earlier: in a document
    of smaller id, or further ahead in the same one. A null id is the smallest. Documents of
    one id are ordered by the hash of their texts; rows alike in id and text are one
    document, and each gets its result. A null text is an empty one. Matches lie within
    documents; they may begin or end inside a character. Columns of the input named like an
    added one are replaced.
    """
    id_ = documents[doc_id]
    key = F.xxhash64(documents[text])
    keyed = documents.select(id_.alias("id"), key.alias("key"), documents[text].alias("text"))
    stretches = repeated_stretches(keyed)
    found = stretches.groupBy("id", "key").agg(F.collect_set(F.struct("begin", "end")).alias("__stretches"))

    kind = pa.struct([("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_bytes", pa.binary()), ("kept_sha256", pa.string())])

    @F.arrow_udf("struct<n_bytes: bigint, n_removed: bigint, n_spans: bigint, kept_bytes: binary, kept_sha256: string>")
    def cut(column: pa.Array, stretches: pa.Array) -> pa.Array:
        rows = [(*row, hashlib.sha256(row[-1]).hexdigest()) for row in _cut(column, stretches)]
        fields = zip(*rows, strict=True) if rows else [[]] * 5
        return pa.StructArray.from_arrays(
            [pa.array(list(values), f.type) for values, f in zip(fields, kind, strict=True)], fields=list(kind)
        )

    kept = without(documents, (*ADDED, "kept_bytes"))
    rows = documents.select(F.struct(*kept).alias("__row"), id_.alias("id"), key.alias("key"), documents[text].alias("text"))
    rows = _with(rows, found)
    once = cut.asNondeterministic()
    rows = rows.select("__row.*", once("text", "__stretches").alias("__cut"))
    return rows.select(*(c for c in rows.columns if c != "__cut"), "__cut.*")
