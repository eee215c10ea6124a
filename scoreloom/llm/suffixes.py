"""Removal of repeated byte strings with suffix arrays, over a whole corpus.

A byte goes if a string of ``span`` bytes that covers it also starts in a document with
a smaller id.  Three exchanges of small parts of the text make this a join:

1. Every window of ``span`` bytes has a smallest hash among its ``GRAM``-byte strings, so
   equal windows share it.  Documents list these hashes; those that another document lists
   too come back as candidates.
2. The runs of candidate windows with one hash are cut out as snippets of little more than
   ``span`` bytes and grouped by the hash.
3. Snippets of whole groups are put in one text of bounded size, whose suffix array is made
   by two-stage sorting: the suffixes smaller than their successors are sorted directly,
   the others follow from a scan of the buckets.  Neighbours with a common prefix of
   ``span`` bytes are equal windows, and all but those of the smallest id go.

Equal rows within a slice of the input are joined before they are shuffled, so a string
that a third of all documents share is a row for each slice, not for each document; whole
copies are found by digest and skip the second step.  A group beyond ``GROUP_BYTES`` is not
held by one task: its windows are sorted over all tasks and compared with their neighbours.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from scoreloom.llm.blocks import as_table, drop
from scoreloom.llm.common import (
    LAST_ID,
    column_of,
    shuffles_released,
    slices,
    stored,
    texts_of,
)

SPAN = 50
GRAM = 20
INNER = 4
# Equal hashes of different strings only add candidates, so they are kept short in the shuffles.
HASH_BITS = 48
SLICE = 2 << 20
PIECE = 1 << 15
GATHERED = 1 << 18
BLOCK_BYTES = 1 << 20
GROUP_BYTES = 32 << 20
# Windows of a group beyond that are handed on whenever they have so many starts.
WINDOW_STARTS = 50_000
# A symbol is a byte plus one, 0 ends a snippet: nine bits, seven to a 64-bit key.
SYMBOL, KEY = 9, 7


# --- hashes of short strings ------------------------------------------------------------------


def gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """A hash of the ``k`` bytes at every place, by doubling."""
    base = 0x9E3779B97F4A7C15 | 1
    power, size = data.astype(np.uint64) + np.uint64(1), 1
    total, have = None, 0
    left = k
    while left:
        if left & 1:
            if total is None:
                total, have = power, size
            else:
                n = len(data) - have - size + 1
                scale = np.uint64(pow(base, size, 1 << 64))
                total, have = total[:n] * scale + power[have : have + n], have + size
        left >>= 1
        if left:
            n = len(data) - 2 * size + 1
            scale = np.uint64(pow(base, size, 1 << 64))
            power, size = power[:n] * scale + power[size : size + n], 2 * size
    total = (total ^ (total >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (total ^ (total >> np.uint64(32))) >> np.uint64(64 - HASH_BITS)


def sampling_order(data: np.ndarray, k: int, inner: int = INNER) -> np.ndarray:
    """Hashes of the ``k``-byte strings, smaller where the middle one of their ``inner``-byte
    strings has the smallest hash.

    Such strings lie evenly in a text, so windows change their smallest string more seldom.
    """
    values = gram_hashes(data, k) >> np.uint64(1)
    short = gram_hashes(data, inner)
    width = k - inner + 1
    middle = short[width // 2 :][: len(values)]
    common = middle != sliding_minima(short, width)[: len(values)]
    return values | (common.astype(np.uint64) << np.uint64(HASH_BITS - 1))


def sliding_minima(values: np.ndarray, width: int) -> np.ndarray:
    size, now = 1, values
    while size * 2 <= width:
        now = np.minimum(now[:-size], now[size:])
        size *= 2
    rest = width - size
    return np.minimum(now[:-rest], now[rest:]) if rest else now


def window_minima(data: np.ndarray, span: int, gram: int) -> np.ndarray:
    """The smallest hash of each window; in pieces whose arrays stay in the processor's cache."""
    return np.concatenate(
        [
            sliding_minima(sampling_order(data[a : a + PIECE + span - 1], gram), span - gram + 1)
            for a in range(0, len(data) - span + 1, PIECE)
        ]
    )


def gathered_bytes(data: np.ndarray, at: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """The strings of these places and lengths, of one or more; indexes are held for some at a time."""
    ends = np.cumsum(lengths)
    out = np.empty(int(ends[-1]), np.uint8)
    i = 0
    while i < len(at):
        begin = int(ends[i] - lengths[i])
        j = max(i + 1, int(np.searchsorted(ends, begin + GATHERED, "right")))
        if j == i + 1:
            out[begin : ends[i]] = data[at[i] : at[i] + lengths[i]]
        else:
            shift = np.repeat(at[i:j] - (ends[i:j] - lengths[i:j]), lengths[i:j])
            out[begin : ends[j - 1]] = data[np.arange(begin, ends[j - 1]) + shift]
        i = j
    offsets = pa.py_buffer(np.r_[0, ends])
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(at), [None, offsets, pa.py_buffer(out)]
    )


class Runs:
    """Runs of windows with one smallest hash, over the texts of a slice.

    hash, text (number in the slice), start (first window, in the text) and size (windows).
    """

    def __init__(self, texts: list[bytes], span: int, gram: int):
        lengths = np.array([len(t) for t in texts], np.int64)
        self.offsets = np.r_[0, np.cumsum(lengths)]
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        empty = np.zeros(0, np.int64)
        self.hash, self.text, self.start, self.size = empty.view(np.uint64), empty, empty, empty
        if len(self.data) < span:
            return
        minima = window_minima(self.data, span, gram)
        counts = np.maximum(0, lengths - span + 1)
        owner = np.repeat(np.arange(len(texts)), counts)
        before = np.cumsum(counts) - counts
        inside = np.arange(counts.sum()) - before[owner]
        at = self.offsets[owner] + inside
        values = minima[at]
        if not len(values):
            return
        new = np.r_[True, (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])]
        first = np.flatnonzero(new)
        self.hash, self.text, self.start = values[first], owner[first], inside[first]
        self.size = np.diff(np.r_[first, len(values)])
        self.minima = minima


# --- suffix arrays ----------------------------------------------------------------------------


def keys_of(symbols: np.ndarray) -> np.ndarray:
    """Seven symbols from every place as one number that sorts like them; zeros beyond the end."""
    s = np.concatenate([symbols, np.zeros(KEY, np.uint16)]).astype(np.uint64)
    bits = [np.uint64(SYMBOL * i) for i in range(5)]
    two = (s[:-1] << bits[1]) | s[1:]
    four = (two[:-2] << bits[2]) | two[2:]
    return ((four[:-3] << bits[3]) | (two[4:] << bits[1])[: len(four) - 3] | s[6:][: len(four) - 3])[
        : len(symbols)
    ]


def smaller_than_next(symbols: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than its successor; the last one counts as smaller."""
    n = len(symbols)
    differs = np.r_[symbols[1:] != symbols[:-1], True]
    place = np.where(differs, np.arange(n), n - 1)
    ahead = np.minimum.accumulate(place[::-1])[::-1]
    following = np.minimum(ahead + 1, n - 1)
    return (symbols[ahead] < symbols[following]) | (ahead == n - 1)


def sort_directly(
    places: np.ndarray, keys: np.ndarray, rest: np.ndarray, depth: int
) -> np.ndarray:
    """``places`` by the first ``depth`` symbols from them, or those up to the end of the snippet.

    First by one key of seven symbols; then those still equal, within their group, by as many
    further symbols as fit beside the number of the group.
    """
    order = np.argsort(keys[places])
    places = places[order]
    equal = keys[places]
    at, done = np.arange(len(places)), KEY
    while len(at):
        new = np.r_[True, equal[1:] != equal[:-1]]
        group = np.cumsum(new) - 1
        mine = places[at]
        # Alone in the group, or ended: equal ones have ended at the same symbol.
        open_ = ~(new & np.r_[new[1:], True]) & (rest[mine] >= done)
        at, mine, group = at[open_], mine[open_], group[open_]
        if done >= depth or not len(at):
            break
        step = min(KEY, (63 - int(group[-1]).bit_length()) // SYMBOL)
        following = keys[np.minimum(mine + done, len(keys) - 1)]
        following >>= np.uint64(SYMBOL * (KEY - step))
        equal = (group.astype(np.uint64) << np.uint64(SYMBOL * step)) | following
        order = np.argsort(equal)
        places[at], equal = mine[order], equal[order]
        done += step
    return places


def suffix_array(symbols: np.ndarray, rest: np.ndarray, depth: int) -> tuple:
    """Suffixes in the order of their first ``depth`` symbols, by two-stage sorting; and the keys.

    ``symbols`` ends with 0, the end of the last snippet; ``rest`` counts the symbols before
    the next 0.
    """
    n = len(symbols)
    keys = keys_of(symbols)
    small = smaller_than_next(symbols)
    sorted_small = sort_directly(np.flatnonzero(small), keys, rest, depth)
    bounds = np.searchsorted(symbols[sorted_small], np.arange(258))
    waiting: list[list[np.ndarray]] = [[] for _ in range(257)]
    out = []

    def induce(scanned: np.ndarray, own: int) -> np.ndarray:
        """Put the predecessors of the scanned suffixes in their buckets; those of ``own`` return."""
        ahead = scanned[scanned > 0] - 1
        ahead = ahead[~small[ahead]]
        symbol = symbols[ahead]
        order = np.argsort(symbol, kind="stable")
        ahead, symbol = ahead[order], symbol[order]
        same = ahead[:0]
        if not len(ahead):
            return same
        cuts = np.flatnonzero(np.r_[True, symbol[1:] != symbol[:-1]])
        for a, b in zip(cuts, [*cuts[1:], len(ahead)], strict=True):
            if symbol[a] == own:
                same = ahead[a:b]
            else:
                waiting[symbol[a]].append(ahead[a:b])
        return same

    for bucket in range(257):
        wave = np.concatenate(waiting[bucket]) if waiting[bucket] else keys[:0].astype(np.int64)
        while len(wave):
            out.append(wave)
            wave = induce(wave, bucket)
        direct = sorted_small[bounds[bucket] : bounds[bucket + 1]]
        if len(direct):
            out.append(direct)
            induce(direct, -1)
    order = np.concatenate(out) if out else np.zeros(0, np.int64)
    assert len(order) == n
    return order, keys


def common_prefixes(order: np.ndarray, keys: np.ndarray, depth: int) -> np.ndarray:
    """Symbols that each suffix shares with the one before it, up to ``depth``; 0 for the first."""
    shared = np.zeros(len(order), np.int64)
    open_ = np.arange(1, len(order))
    for done in range(0, depth, KEY):
        a, b = order[open_ - 1] + done, order[open_] + done
        n = len(keys) - 1
        x = keys[np.minimum(a, n)] ^ keys[np.minimum(b, n)]
        other = x != 0
        apart = x[other]
        shared[open_] += KEY
        shared[open_[other]] -= sum((apart >> np.uint64(SYMBOL * i)) != 0 for i in range(KEY))
        open_ = open_[~other]
        if not len(open_):
            break
    return np.minimum(shared, depth)


def repeated_windows(
    snippets: list[bytes], owners: np.ndarray, span: int
) -> tuple[np.ndarray, np.ndarray]:
    """(snippet, place) of every window of ``span`` bytes that a smaller owner has too."""
    lengths = np.array([len(s) for s in snippets], np.int64)
    n = int(lengths.sum()) + len(snippets)
    ends = np.cumsum(lengths + 1) - 1
    symbols = np.frombuffer(b"\0".join(snippets) + b"\0", np.uint8).astype(np.uint16) + 1
    symbols[ends] = 0
    snippet = np.repeat(np.arange(len(snippets)), lengths + 1)
    place = np.arange(n) - (ends - lengths)[snippet]
    rest = lengths[snippet] - place
    depth = -(-span // KEY) * KEY
    order, keys = suffix_array(symbols, rest, depth)
    order = order[rest[order] >= span]
    if not len(order):
        return order, order
    new = common_prefixes(order, keys, depth) < span
    owner = owners[snippet[order]]
    least = np.minimum.reduceat(owner, np.flatnonzero(new))[np.cumsum(new) - 1]
    gone = np.sort(order[owner > least])
    return snippet[gone], place[gone]


# --- the three exchanges ----------------------------------------------------------------------

MARKS = "hash long, doc long, twin long"
LISTED = "doc long, twin long, hashes array<long>, answered boolean"
SNIPPETS = (
    "hash long, snippet binary, doc long, twin long, start long, more array<long>, size long"
)
SPANS = "doc long, twin long, start long, end long"
# Spans, and the snippets of groups beyond the limit, whose windows are compared after.
FOUND = f"{SPANS}, snippet binary, more array<long>"


def _marks(span: int, gram: int):
    """Each document's distinct smallest hashes, as lists.

    A hash that several documents of the slice have needs no answer: they are candidates at
    once (the rows ``answered``), and one row without a document speaks for them among the
    others.  Both kinds must come of one pass: another may cut the slices elsewhere.  Repeated
    rows of a slice are one document.
    """

    def rows(
        part: pa.RecordBatch, texts: np.ndarray, hashes: np.ndarray, answered: bool
    ) -> pa.RecordBatch:
        """A row for each text; text -1 is that without a document."""
        order = np.argsort(texts, kind="stable")
        texts, hashes = texts[order], hashes[order]
        first = np.flatnonzero(np.r_[True, texts[1:] != texts[:-1]][: len(texts)])
        offsets = pa.array(np.r_[first, len(texts)], pa.int32())
        owner = texts[first]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(column_of(part, "doc").to_numpy()[owner], mask=owner < 0),
                pa.array(column_of(part, "twin").to_numpy()[owner]),
                pa.ListArray.from_arrays(offsets, pa.array(hashes.view(np.int64))),
                pa.array(np.full(len(first), answered)),
            ],
            ["doc", "twin", "hashes", "answered"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SLICE):
            keys = zip(*(column_of(part, c).to_pylist() for c in ("doc", "twin")), strict=True)
            once = {k: i for i, k in enumerate(keys)}
            if len(once) < part.num_rows:
                part = part.take(pa.array(sorted(once.values())))
            runs = Runs(texts_of(part), span, gram)
            if not len(runs.hash):
                continue
            order = np.lexsort((runs.text, runs.hash))
            h, t = runs.hash[order], runs.text[order]
            first = np.r_[True, (h[1:] != h[:-1]) | (t[1:] != t[:-1])]
            h, t = h[first], t[first]
            new = np.r_[True, h[1:] != h[:-1]]
            several = ~(new & np.r_[new[1:], True])
            asked = new | ~several
            yield rows(part, np.where(several, -1, t)[asked], h[asked], False)
            if several.any():
                yield rows(part, t[several], h[several], True)

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The marks whose hash has more than one row, with their document; sorted by hash."""
    held: pa.RecordBatch | None = None  # the last row, if it is the first of its hash
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        h = column_of(batch, "hash").to_numpy()
        new = np.r_[h[0] != last, h[1:] != h[:-1]]
        shared = ~(new & np.r_[new[1:], True])
        if held is not None:
            if not new[0]:
                yield held
            held = None
        if not shared[-1]:
            held = batch.slice(batch.num_rows - 1)
        last = int(h[-1])
        yield batch.filter(pa.array(shared))


def _snippets(span: int, gram: int):
    """Snippets of the candidate windows of each document.

    Equal snippets of a slice are one row, of the smallest id; in the others they are repeated
    for certain and go on as spans (rows without a snippet, spread over the tasks).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SLICE):
            texts = texts_of(part)
            runs = Runs(texts, span, gram)
            if not len(runs.hash):
                continue
            docs = column_of(part, "doc").to_numpy()
            twins = column_of(part, "twin").to_numpy()
            lists = column_of(part, "hashes")
            counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            owner = np.repeat(np.arange(len(texts)), counts)
            salt = np.arange(len(texts)).astype(np.uint64) << np.uint64(HASH_BITS)
            wanted = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64) | salt[owner]
            chosen = np.isin(runs.hash | salt[runs.text], wanted)
            chosen = np.flatnonzero(chosen)
            if not len(chosen):
                continue
            at = runs.offsets[runs.text[chosen]] + runs.start[chosen]
            lengths = runs.size[chosen] - 1 + span
            coded = gathered_bytes(runs.data, at, lengths).dictionary_encode()
            # By snippet, then as they came: by text and start.
            code = coded.indices.to_numpy()
            order = np.argsort(code, kind="stable")
            code, chosen, lengths = code[order], chosen[order], lengths[order]
            text, start = runs.text[chosen], runs.start[chosen]
            new = np.r_[True, (code[1:] != code[:-1]) | (text[1:] != text[:-1])]
            first = np.flatnonzero(new)
            code, doc, counts = code[first], docs[text[first]], np.diff(np.r_[first, len(new)])
            least = np.full(len(coded.dictionary), LAST_ID)
            np.minimum.at(least, code, doc)
            own = doc == least[code]
            spread = (doc.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(1)).view(
                np.int64
            )
            more = pa.ListArray.from_arrays(
                pa.array(np.r_[0, np.cumsum(counts - 1)], pa.int32()),
                pa.array(start[~new]),
                mask=pa.array(counts == 1),
            )
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.where(own, runs.hash[chosen[first]].view(np.int64), spread)),
                    coded.dictionary.take(pa.array(code, mask=~own)).cast(pa.binary()),
                    pa.array(doc),
                    pa.array(twins[text[first]]),
                    pa.array(start[first]),
                    more,
                    pa.array(np.where(own, 0, lengths[first])),
                ],
                ["hash", "snippet", "doc", "twin", "start", "more", "size"],
            )

    return run


def _span_rows(docs, twins, starts, ends) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.asarray(x, np.int64)) for x in (docs, twins, starts, ends)],
        ["doc", "twin", "start", "end"],
    )


def _starts(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(row, start) of every place of the rows' snippets, by row."""
    more = column_of(rows, "more")
    counts = more.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    each = np.r_[np.arange(rows.num_rows), np.repeat(np.arange(rows.num_rows), counts)]
    flat = more.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    starts = np.r_[column_of(rows, "start").to_numpy(), flat]
    order = np.argsort(each, kind="stable")
    return each[order], starts[order]


def _whole_spans(rows: pa.RecordBatch, sizes: np.ndarray) -> pa.RecordBatch:
    """Spans of snippets that go as they are."""
    docs, twins = (column_of(rows, c).to_numpy() for c in ("doc", "twin"))
    each, starts = _starts(rows)
    return _span_rows(docs[each], twins[each], starts, starts + sizes[each])


def _later_equals(rows: pa.RecordBatch) -> np.ndarray:
    """Whether a smaller id has a snippet equal to the row's: all its windows then go."""
    coded = column_of(rows, "snippet").dictionary_encode()
    code, docs = coded.indices.to_numpy(), column_of(rows, "doc").to_numpy()
    least = np.full(len(coded.dictionary), LAST_ID)
    np.minimum.at(least, code, docs)
    return docs > least[code]


def _block_spans(rows: pa.RecordBatch, span: int) -> pa.RecordBatch:
    """Spans that go, of whole groups of snippets."""
    snippets = column_of(rows, "snippet").to_pylist()
    docs = column_of(rows, "doc").to_numpy()
    twins = column_of(rows, "twin").to_numpy()
    which, place = repeated_windows(snippets, docs, span)
    new = np.r_[True, (which[1:] != which[:-1]) | (place[1:] != place[:-1] + 1)]
    if not len(which):
        return _span_rows([], [], [], [])
    first = np.flatnonzero(new)
    last = np.r_[first[1:], len(which)] - 1
    which, begin, end = which[first], place[first], place[last] + span
    owner, starts = _starts(rows)
    offsets = np.searchsorted(owner, np.arange(rows.num_rows + 1))
    many = np.diff(offsets)[which]
    each = np.repeat(np.arange(len(which)), many)
    inner = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    base = starts[offsets[which[each]] + inner]
    row = which[each]
    return _span_rows(docs[row], twins[row], base + begin[each], base + end[each])


def _groups(batches: Iterator[pa.RecordBatch], block: int, limit: int):
    """Consecutive rows as (whole groups, False), about ``block`` bytes, or (part, True) of a
    group beyond ``limit`` bytes."""
    done: list[pa.RecordBatch] = []
    now: list[pa.RecordBatch] = []
    done_bytes, now_bytes, hot, last = 0, 0, False, None

    def joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        return pa.concat_batches(parts) if len(parts) > 1 else parts[0]

    for batch in slices(batches, "snippet", block):
        h = column_of(batch, "hash").to_numpy()
        starts = np.flatnonzero(np.r_[last is None or h[0] != last, h[1:] != h[:-1]]).tolist()
        last = int(h[-1])
        if starts:
            if starts[0]:
                now.append(batch.slice(0, starts[0]))
            if hot and now:
                yield joined(now), True
            elif not hot:
                done += now
                done_bytes += sum(x.nbytes for x in now)
            if starts[-1] > starts[0]:
                done.append(batch.slice(starts[0], starts[-1] - starts[0]))
                done_bytes += done[-1].nbytes
            if done_bytes >= block:
                yield joined(done), False
                done, done_bytes = [], 0
            now, now_bytes, hot = [], 0, False
        now.append(batch.slice(starts[-1] if starts else 0))
        now_bytes += now[-1].nbytes
        if now_bytes > limit:
            yield joined(now), True
            now, hot = [], True
    if hot and now:
        yield joined(now), True
    elif not hot:
        done += now
    if done:
        yield joined(done), False


def _settled(spans: pa.RecordBatch) -> pa.RecordBatch:
    """Spans as rows of ``FOUND``."""
    n = spans.num_rows
    columns = [*spans.columns, pa.nulls(n, pa.binary()), pa.nulls(n, pa.list_(pa.int64()))]
    return pa.RecordBatch.from_arrays(columns, [*spans.schema.names, "snippet", "more"])


def _open(rows: pa.RecordBatch) -> pa.RecordBatch:
    """Snippets of a group beyond the limit as rows of ``FOUND``, without an end."""
    return pa.RecordBatch.from_arrays(
        [
            *(column_of(rows, c) for c in ("doc", "twin", "start")),
            pa.nulls(rows.num_rows, pa.int64()),
            column_of(rows, "snippet").cast(pa.binary()),
            column_of(rows, "more").cast(pa.list_(pa.int64())),
        ],
        ["doc", "twin", "start", "end", "snippet", "more"],
    )


def _compared(span: int, block: int, limit: int):
    """Spans of groups within the limit and those that need no comparison; the snippets of
    groups beyond the limit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, hot in _groups(batches, block, limit):
            given = column_of(rows, "snippet").is_null()
            certain = rows.filter(given)
            if certain.num_rows:
                yield _settled(_whole_spans(certain, column_of(certain, "size").to_numpy()))
            rest = rows.filter(pa.compute.invert(given)) if certain.num_rows else rows
            if not rest.num_rows:
                continue
            later = _later_equals(rest)
            if later.any():
                gone = rest.filter(pa.array(later))
                sizes = pa.compute.binary_length(column_of(gone, "snippet")).to_numpy()
                yield _settled(_whole_spans(gone, sizes.astype(np.int64)))
                rest = rest.filter(pa.array(~later))
            if hot:
                yield _open(rest)
            elif rest.num_rows > 1:
                yield _settled(_block_spans(rest, span))

    return run


def _hot_windows(span: int):
    """The windows of open snippets, a row each, in batches of bounded size."""

    def table(found: list[tuple]) -> pa.RecordBatch:
        whole = pa.int64()
        kinds = [pa.binary(), whole, whole, pa.list_(whole)]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)],
            ["window", "doc", "twin", "starts"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, n = [], 0
        for rows in batches:
            given = [column_of(rows, c) for c in ("snippet", "doc", "twin", "start", "more")]
            for row in zip(*given, strict=True):
                snippet, doc, twin, start, more = (x.as_py() for x in row)
                begins = [start, *(more or ())]
                for i in range(len(snippet) - span + 1):
                    found.append((snippet[i : i + span], doc, twin, [b + i for b in begins]))
                    n += len(begins)
                    if n >= WINDOW_STARTS:
                        yield table(found)
                        found, n = [], 0
        if found:
            yield table(found)

    return run


def _later_windows(span: int):
    """Spans of the windows equal to one of a smaller id; rows come sorted by window and id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        window, least = None, None
        for batch in batches:
            out: list[tuple] = []
            for found, doc, twin, starts in zip(
                *(column_of(batch, c).to_pylist() for c in ("window", "doc", "twin", "starts")),
                strict=True,
            ):
                if found != window:
                    window, least = found, doc
                elif doc > least:
                    out += [(doc, twin, s, s + span) for s in starts]
            if out:
                yield _span_rows(*zip(*out, strict=True))

    return run


def _cut():
    """Put what is left in the place of each text, and add its bytes and what was counted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SLICE):
            texts = texts_of(part)
            lists = column_of(part, "_spans")
            counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            flat = lists.flatten()
            owner = np.repeat(np.arange(len(texts)), counts)
            start, end = (
                flat.field(c).to_numpy(zero_copy_only=False).astype(np.int64)
                for c in ("start", "end")
            )
            order = np.lexsort((start, owner))
            owner, start, end = owner[order], start[order], end[order]
            bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
            kept, removed, spans = [], [], []
            for i, value in enumerate(texts):
                a, b = bounds[i], bounds[i + 1]
                at, gone, n, pieces = 0, 0, 0, []
                if b > a:
                    reach = np.maximum.accumulate(end[a:b])
                    new = np.r_[True, start[a + 1 : b] > reach[:-1]]
                    first = np.flatnonzero(new)
                    stops = reach[np.r_[first[1:], b - a] - 1]
                    for s, e in zip(start[a:b][first].tolist(), stops.tolist(), strict=True):
                        pieces.append(value[at:s])
                        at, gone, n = e, gone + e - s, n + 1
                pieces.append(value[at:])
                kept.append(b"".join(pieces))
                removed.append(gone)
                spans.append(n)
            nulls = column_of(part, "text").is_null().to_pylist()
            left = [
                None if null else value.decode("utf-8", "ignore")
                for value, null in zip(kept, nulls, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    column_of(part, "row"),
                    pa.array(left, pa.string()),
                    pa.array(kept, pa.binary()),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(spans, pa.int64()),
                ],
                ["row", "text", "kept", "n_bytes", "n_removed", "n_spans"],
            )

    return run


ADDED = "kept binary, n_bytes long, n_removed long, n_spans long"


def remove_repeats(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    span: int = SPAN,
    gram: int = GRAM,
    block_bytes: int = BLOCK_BYTES,
    group_bytes: int = GROUP_BYTES,
) -> DataFrame:
    """``documents`` with what is left of the text, kept (its bytes), n_bytes, n_removed, n_spans.

    In the text, characters of which only some bytes are left are dropped; a null stays null.
    ``key`` is a long.  A null key counts as larger than all others; rows of equal keys take
    nothing from each other, whether their texts are equal or not.  A null text is empty;
    texts shorter than ``span`` bytes lose nothing.  All strings are compared as they were in
    the input.  Repeated rows get equal results.  Columns named like the added ones are
    replaced; all others keep their names, types and values.
    """
    left = _left(documents, key, text, span, gram, block_bytes, group_bytes)
    added = StructType.fromDDL(ADDED).names
    names = [c for c in documents.columns if c not in added]
    return left.select(*(_own(c, text) for c in names), *added)


def _own(name: str, text: str) -> Column:
    """A column of the caller, out of the rows of ``_left``."""
    return (F.col("text") if name == text else F.col("row").getField(name)).alias(name)


def _left(
    documents: DataFrame,
    key: str,
    text: str,
    span: int,
    gram: int = GRAM,
    block_bytes: int = BLOCK_BYTES,
    group_bytes: int = GROUP_BYTES,
) -> DataFrame:
    """row (the caller's columns but the text), text (what is left) and the columns of ``ADDED``.

    Hashes, candidates and spans are written one after the other, and the files of the shuffles
    before are let go, so that the disk holds those of one step at a time.
    """
    doc = F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(LAST_ID))
    with shuffles_released(documents.sparkSession):
        spans, twin, gathered = _found_spans(
            documents, doc, text, span, gram, block_bytes, group_bytes
        )
    later = (
        spans.filter("snippet IS NOT NULL")
        .repartition("doc", "start")
        .mapInArrow(_hot_windows(span), "window binary, doc long, twin long, starts array<long>")
        .repartition("window")
        .sortWithinPartitions("window", "doc")
        .mapInArrow(_later_windows(span), SPANS)
    )
    by_text = (
        spans.filter("end IS NOT NULL")
        .select("doc", "twin", "start", "end")
        .union(later)
        .groupBy("doc", "twin")
        .agg(gathered(F.struct("start", "end")).alias("_spans"))
    )
    others = [F.col(f"`{c}`") for c in documents.columns if c != text]
    rows = documents.select(
        F.struct(*others).alias("row"),
        F.col(f"`{text}`").alias("text"),
        doc.alias("doc"),
        twin.alias("twin"),
    )
    joined = rows.join(by_text, ["doc", "twin"], "left").select("row", "text", "_spans")
    fields = StructType.fromDDL(ADDED).fields
    schema = StructType([*rows.select("row", "text").schema.fields, *fields])
    return joined.mapInArrow(_cut(), schema)


def _found_spans(
    documents: DataFrame,
    doc: Column,
    text: str,
    span: int,
    gram: int,
    block_bytes: int,
    group_bytes: int,
) -> tuple[DataFrame, Column, Callable[[Column], Column]]:
    """The written rows of ``FOUND``; what tells texts of one key apart; how to gather their spans."""
    spark = documents.sparkSession
    repeated_keys = documents.groupBy(doc.alias("doc")).count().filter("count > 1")
    # Texts of one key are told apart by a hash, which is left out where keys are unique.
    # Repeated rows then bring equal hashes and spans, which are kept once.
    twin: Column = F.lit(0).cast("long")
    gathered = F.collect_list
    if not repeated_keys.isEmpty():
        gathered = F.collect_set
        twin = F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit("")))
    plain = documents.select(
        doc.alias("doc"), twin.alias("twin"), F.col(f"`{text}`").alias("text")
    )

    # Whole copies of a document with a smaller id.
    size = F.octet_length(F.col("text"))
    digest = F.unhex(F.sha2(F.col("text").cast("binary"), 256))
    digests = plain.filter(size >= span).select(
        "doc", "twin", digest.alias("digest"), size.cast("long").alias("size")
    )
    digests = stored(digests, "digests")
    least = digests.groupBy("digest").agg(F.min("doc").alias("least"), F.count("*").alias("n"))
    copies = digests.join(least.filter("n > 1"), "digest").filter("doc > least")
    copies = stored(copies.select("doc", "twin", "size"), "copies")

    held = as_table(plain.mapInArrow(_marks(span, gram), LISTED), "marks")
    marks = spark.table(held)
    each = F.explode("hashes").alias("hash")
    asked = marks.filter("NOT answered").select(each, "doc", "twin")
    shared = asked.repartition("hash").sortWithinPartitions("hash").mapInArrow(_shared, MARKS)
    known = marks.filter("answered").select(each, "doc", "twin")
    none = F.lit(None).cast("long")
    # Of one key and one distinct text each, so that many texts under a key are no single row.
    # Whole copies go without comparison.
    candidates = stored(
        shared.filter("doc IS NOT NULL")
        .union(known)
        .select("doc", "twin", "hash", F.lit(False).alias("copy"))
        .union(copies.select("doc", "twin", none.alias("hash"), F.lit(True).alias("copy")))
        .groupBy("doc", "twin")
        .agg(gathered("hash").alias("hashes"), F.max("copy").alias("copied"))
        .filter("NOT copied")
        .drop("copied"),
        "candidates",
    )
    drop(spark, held)
    snippets = plain.join(candidates, ["doc", "twin"]).mapInArrow(_snippets(span, gram), SNIPPETS)
    grouped = snippets.repartition("hash").sortWithinPartitions("hash")
    compared = grouped.mapInArrow(_compared(span, block_bytes, group_bytes), FOUND)
    whole = copies.select(
        "doc",
        "twin",
        F.lit(0).cast("long").alias("start"),
        F.col("size").alias("end"),
        F.lit(None).cast("binary").alias("snippet"),
        F.lit(None).cast("array<long>").alias("more"),
    )
    return stored(compared, "spans").union(whole), twin, gathered


def without_repeats(documents: DataFrame, key: str = "doc_id", span: int = SPAN) -> DataFrame:
    """The documents, with their columns and the repeated bytes taken out of ``text``.

    A text of which nothing is left stays as an empty one.  n_chars, if there is such a column,
    counts what is left of the texts that lost something.  All other columns stay as they are,
    whatever their names.
    """
    left = _left(documents, key, "text", span)
    columns = {c: _own(c, "text") for c in documents.columns}
    if "n_chars" in columns:
        counted = F.char_length("text").cast(documents.schema["n_chars"].dataType)
        cut = F.when(F.col("n_removed") > 0, counted).otherwise(columns["n_chars"])
        columns["n_chars"] = cut.alias("n_chars")
    return left.select(*columns.values())
