"""Suffix-array dedup: remove bytes of passages that an earlier document has.

A byte goes if a string of LEAST bytes that covers it also starts in a document
with a smaller doc_id.  The method is an enhanced suffix array whose common-
prefix intervals are scanned with a stack; intervals whose occurrences differ
in the byte before them are the maximal repeats, and each gives its group of all
occurrences, not just of neighbours.

One array over the corpus would not fit anywhere, so it is cut into shards by
content.  Every window of LEAST bytes has a key, the smallest hash of its
GRAM-byte strings; equal windows have equal keys wherever they stand.  A run of
windows with one key is a segment, and a shard holds the segments of some keys,
so each pair of equal windows meets in one shard:

1. Texts are stored in batches of about BATCH bytes.
2. Batches send their distinct keys; keys of two or more batches come back, with
   a mark if they have over HOT segments.  Whole texts that an earlier document
   has are told by their digests and take no further part.
3. Batches send the segments of shared keys, each distinct one once, with the
   smallest and largest doc_id that has it.  A hot key's segments go window by
   window to shards chosen by content, so no task gets all of them.
4. A shard builds its suffix array (of suffixes of at least LEAST bytes), the
   array of common prefixes and the interval tree, and returns each repeat's
   place, length and smallest doc_id to the batches it occurs in.
5. Batches cover those bytes and put out what is left.

Hashes only choose what meets where; bytes are removed by comparing bytes (and
whole texts by 128-bit digest).

Defined results: a null text is empty; texts below LEAST bytes lose nothing;
rows with equal doc_ids do not remove from each other; a null doc_id counts as
larger than every other; repeats inside one document stay; extra columns are
ignored; an empty table gives no row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm.batches import stored as store_texts
from granary.llm.batches import NULL, at_batches, by_bucket, opened, pack, record, rest_columns, squeeze, to_buckets, unpack, unsqueeze
from granary.llm.common import dropped, lean, partitions, scratch, tidy, written

LEAST = 50
GRAM = 16
BATCH = 2 << 20
#: Different segments of one key, summed over batches, from which its windows
#: are dealt out singly.
HOT = 1 << 14
#: Windows of a segment at most; longer runs are several segments.
RUN = 47
#: Suffixes of a shard's array at most, but for the last key's.
SHARD = 40_000
#: Spans of a bucket that are held before they are dealt out to their batches.
FOUND = 1 << 20
#: Segments that are laid out as a matrix at a time.
_ROWS = 1 << 13
_SLICE = 1 << 16
_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


# ---- windows and their keys -------------------------------------------------


def _mix(x: np.ndarray) -> np.ndarray:
    x ^= x >> np.uint64(32)
    x *= _M[3]
    x ^= x >> np.uint64(29)
    return x


def window_keys(text: np.ndarray) -> np.ndarray:
    """Key of each window of LEAST bytes: the least hash of its GRAM-byte strings."""
    n = len(text) - LEAST + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.empty(n, np.uint64)
    width = LEAST - GRAM + 1
    for at in range(0, n, _SLICE):
        m = min(_SLICE, n - at)
        raw = np.ascontiguousarray(text[at : at + m + LEAST - 1])
        word = np.lib.stride_tricks.as_strided(raw[:8].view("<u8"), (len(raw) - 7,), (1,))
        k = len(raw) - GRAM + 1
        h = word[:k] * _M[0]
        h ^= h >> np.uint64(31)
        for i in range(1, GRAM // 8):
            h += word[8 * i : 8 * i + k]
            h *= _M[i]
            h ^= h >> np.uint64(30)
        h = _mix(h)
        size = 1
        while 2 * size <= width:
            h = np.minimum(h[:-size], h[size:])
            size *= 2
        if size < width:
            h = np.minimum(h[: len(h) - (width - size)], h[width - size :])
        out[at : at + m] = h[:m]
    return out


def runs(text: np.ndarray, lens: np.ndarray, skip: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, number of windows, key) of the runs in the texts not skipped."""
    keys = window_keys(text)
    ends = np.cumsum(lens)
    good = np.zeros(len(keys) + 1, bool)
    new = np.zeros(len(keys) + 1, bool)
    for a, b, no in zip((ends - lens).tolist(), ends.tolist(), skip.tolist()):
        if b - a >= LEAST and not no:
            good[a : b - LEAST + 1] = True
            new[a] = new[b - LEAST + 1] = True
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), keys
    new[1:-1] |= keys[1:] != keys[:-1]
    new[0] = True
    start = np.flatnonzero(new)
    size = np.diff(np.append(start, len(keys)))
    keep = good[start] & (size > 0)
    start, size = start[keep], size[keep]
    if (size > RUN).any():
        parts = -(-size // RUN)
        inner = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        start, size = np.repeat(start, parts) + inner * RUN, np.minimum(RUN, np.repeat(size, parts) - inner * RUN)
    return start, size, keys[start]


# ---- the enhanced suffix array ----------------------------------------------


def _again(padded: np.ndarray, seg: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Which windows' bytes may stand at another place too."""
    if not len(seg):
        return np.zeros(0, bool)
    word, at, h = _words(padded.ravel()), seg * padded.shape[1] + off, np.zeros(len(seg), np.uint64)
    for w in (0, 14, 28, LEAST - 8):
        h = (h ^ word[at + w]) * _M[0]
        h ^= h >> np.uint64(32)
    h = (h * _M[1]) >> np.uint64(61 - len(seg).bit_length())
    return np.bincount(h.view(np.int64), minlength=1)[h.view(np.int64)] > 1


class SuffixArray:
    """Suffixes of at least LEAST bytes of short segments, in order.

    ``rows``: segments as a zero-padded byte matrix; ``lens``: their lengths.
    ``lcp[i]`` is the common prefix of the suffixes at ranks i and i + 1.
    Suffixes whose first LEAST bytes no other has are left out, as far as a hash
    tells: no repeat has them, and segments that met by chance are mostly such.
    """

    def __init__(self, rows: np.ndarray, lens: np.ndarray) -> None:
        width = rows.shape[1]
        count = np.maximum(lens - LEAST + 1, 0)
        seg = np.repeat(np.arange(len(lens)), count)
        off = np.arange(len(seg)) - np.repeat(np.cumsum(count) - count, count)
        padded = np.zeros((len(rows), 2 * width), np.uint8)
        padded[:, :width] = rows
        some = _again(padded, seg, off)
        seg, off = seg[some], off[some]
        size = lens[seg] - off
        # The length, in the last byte, puts a suffix before its extensions even
        # where the text goes on with zero bytes.
        text = np.zeros((len(seg), width + 1), np.uint8)
        text[:, :width] = np.lib.stride_tricks.sliding_window_view(padded, width, axis=1)[seg, off]
        text[:, width] = size
        order = np.argsort(text.view(f"S{width + 1}").ravel(), kind="stable")
        text, size = text[order, :width], size[order]
        self.seg, self.off = seg[order], off[order]
        lcp = np.zeros(max(0, len(order) - 1), np.int64)
        for at in range(0, len(lcp), _SLICE):
            differ = text[at : at + _SLICE + 1][1:] != text[at : at + _SLICE + 1][:-1]
            lcp[at : at + len(differ)] = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
        self.lcp = np.minimum(lcp, np.minimum(size[1:], size[:-1])) if len(lcp) else lcp
        # The byte before a suffix; a segment's first suffix has none that could
        # extend the repeat within this array.
        self.left = np.where(self.off > 0, padded[self.seg, self.off - 1].astype(np.int64), -1)

    def repeats(self, value: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(first rank, last rank, length, least value) of each maximal repeat.

        ``value`` has a number for each segment.  Intervals are closed on a
        stack; one whose occurrences share the byte before them is not maximal.
        """
        strong = self.lcp >= LEAST
        if not strong.any():
            return
        edge = np.flatnonzero(np.diff(np.concatenate([[0], strong.astype(np.int8), [0]])))
        of = value[self.seg]
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
            lcp, left, least = self.lcp[a:b].tolist(), self.left[a : b + 1].tolist(), of[a : b + 1].tolist()
            stack: list[list[int]] = []  # length, first rank, byte before or -1 if they differ, least value
            for i in range(b - a + 1):
                depth = lcp[i] if i < b - a else 0
                node = [i, left[i], least[i]]
                while stack and stack[-1][0] > depth:
                    length, first, before, low = stack.pop()
                    before = before if before == node[1] else -1
                    low = min(low, node[2])
                    if before < 0:
                        yield a + first, a + i, length, low
                    node = [first, before, low]
                if depth:
                    if stack and stack[-1][0] == depth:
                        top = stack[-1]
                        top[2] = top[2] if top[2] == node[1] else -1
                        top[3] = min(top[3], node[2])
                    else:
                        stack.append([depth, *node])


def spans(rows: np.ndarray, lens: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
    """(segment, offset, length, least doc) of bytes that smaller documents have.

    ``low`` and ``high`` are the least and greatest document of a segment;
    spans that no document of the segment is above are left out.
    """
    whole = np.flatnonzero(low < high)  # a segment of several documents is a repeat itself
    out = [(whole, np.zeros(len(whole), np.int64), lens[whole].astype(np.int64), low[whole])]
    array = SuffixArray(rows, lens)
    groups = np.array(list(array.repeats(low)), np.int64).reshape(-1, 4)
    if len(groups):
        n = groups[:, 1] - groups[:, 0] + 1
        rank = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - groups[:, 0], n)
        seg, least = array.seg[rank], np.repeat(groups[:, 3], n)
        keep = least < high[seg]
        out.append((seg[keep], array.off[rank][keep], np.repeat(groups[:, 2], n)[keep], least[keep]))
    return tuple(np.concatenate(x) for x in zip(*out))


# ---- batches ----------------------------------------------------------------


def _digests(text: np.ndarray, lens: np.ndarray) -> np.ndarray:
    import xxhash

    ends, view = np.cumsum(lens), memoryview(text)
    return np.frombuffer(b"".join(xxhash.xxh3_128_digest(view[b - n : b]) for b, n in zip(ends.tolist(), lens.tolist())), "S16") if len(lens) else np.zeros(0, "S16")


def _hex(d: np.ndarray) -> np.ndarray:
    return np.frombuffer(d.tobytes(), ">u8").reshape(-1, 2)


def _first_here(digest: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place of each distinct text, its least doc, each row's distinct text)."""
    d = _hex(digest)
    order = np.lexsort((key, d[:, 1], d[:, 0]))
    new = np.ones(len(order), bool)
    new[1:] = (d[order][1:] != d[order][:-1]).any(axis=1)
    of = np.empty(len(order), np.int64)
    of[order] = np.cumsum(new) - 1
    return order[new], key[order[new]], of


def _short(keys: np.ndarray, bucket) -> np.ndarray:
    """48 bits of a key and 16 of its bucket."""
    return ((keys & np.uint64((1 << 48) - 1)) << np.uint64(16)) | (np.asarray(bucket).astype(np.uint64) & np.uint64(0xFFFF))


def _words(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as one number."""
    return np.lib.stride_tricks.as_strided(text[:8].view("<u8"), (len(text) - 7,), (1,))


def _kinds(text: np.ndarray, start: np.ndarray, size: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and how many different segments each has."""
    distinct, of, runs_ = np.unique(keys, return_inverse=True, return_counts=True)
    count = np.ones(len(distinct), np.int64)
    rows = np.flatnonzero((runs_ > 1)[of])
    if len(rows):
        at, length, word = start[rows], size[rows] + LEAST - 1, _words(text)
        h = _mix((word[at + length - 8] + length.astype(np.uint64)) * _M[0])
        for w in range(0, RUN + LEAST - 9, 8):
            more = w + 8 < length
            h[more] = _mix((h[more] ^ word[at[more] + w]) * _M[1])
        order = np.lexsort((h, of[rows]))
        key, h = of[rows][order], h[order]
        new = np.append(True, (key[1:] != key[:-1]) | (h[1:] != h[:-1]))
        count = np.maximum(count, np.bincount(key[new], minlength=len(distinct)))
    return distinct, count


def _ask(buckets: int):
    """Stored batches to rows: kind 0, keys by bucket; kind 1, texts' digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for batch, docs, texts in zip(*(c.to_pylist() for c in b.columns)):
                key, _, lens, text = opened(docs, texts)
                digest = _digests(text, lens)
                first, least, of = _first_here(digest, key)
                again = key > least[of]
                keys, count = _kinds(text, *runs(text, lens, again))
                bucket = (keys % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
                out = []
                for k in np.flatnonzero(np.diff(cut)).tolist():
                    rows = order[cut[k] : cut[k + 1]]
                    # 48 bits of a key are enough to find which ones are shared.
                    short = keys[rows].view(np.uint8).reshape(-1, 8)[:, :6]
                    many = np.flatnonzero(count[rows] > 1).astype("<u4")
                    out.append((k, 0, short.tobytes(), pack(many, np.minimum(count[rows][many], 1 << 30).astype("<u4"))))
                d = _hex(digest)[first]
                place = (d[:, 1] % np.uint64(buckets)).astype(np.int64)
                long_enough = lens[first] >= LEAST
                for k in np.unique(place[long_enough]).tolist():
                    rows = np.flatnonzero((place == k) & long_enough)
                    out.append((k, 1, np.ascontiguousarray(d[rows]).tobytes(), least[rows].astype("<i8").tobytes()))
                if out:
                    k, kind, keys, more = zip(*out)
                    yield record(bucket=k, kind=kind, batch=[batch] * len(k), data=keys, more=more)

    return run


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per bucket and batch: the keys that others have too (kind 0; with a mark
    for hot ones) and the texts that an earlier document has (kind 1)."""
    for bucket, rows in by_bucket(batches):
        out = []
        mine = [r for r in rows if r["kind"] == 0]
        if mine:
            parts = []
            for r in mine:
                wide = np.zeros((len(r["data"]) // 6, 8), np.uint8)
                wide[:, :6] = np.frombuffer(r["data"], np.uint8).reshape(-1, 6)
                parts.append(wide.view("<u8").ravel())
            sizes = [len(p) for p in parts]
            keys, who = np.concatenate(parts), np.repeat(np.arange(len(mine)), sizes)
            count = np.ones(len(keys), np.int64)
            for base, r in zip(np.cumsum(sizes) - sizes, mine):
                many, n = unpack(r["more"], "<u4", "<u4")
                count[base + many.astype(np.int64)] = n
            order = np.argsort(keys, kind="stable")
            new = np.ones(len(order), bool)
            new[1:] = keys[order][1:] != keys[order][:-1]
            start = np.flatnonzero(new)
            group = np.cumsum(new) - 1
            held = np.diff(np.append(start, len(order)))  # a batch sends a key once
            hot = np.add.reduceat(count[order], start) > HOT
            shared = (held > 1)[group]
            at, flag = order[shared], hot[group][shared]
            sort = np.argsort(who[at], kind="stable")
            at, flag = at[sort], flag[sort]
            cut = np.searchsorted(who[at], np.arange(len(mine) + 1))
            for k, r in enumerate(mine):
                a, b = cut[k], cut[k + 1]
                if a < b:
                    out.append((r["batch"], 0, pack(_short(keys[at[a:b]], bucket), flag[a:b])))
        whole = [r for r in rows if r["kind"] == 1]
        if whole:
            sizes = [len(r["data"]) // 16 for r in whole]
            d = np.concatenate([np.frombuffer(r["data"], "<u8").reshape(-1, 2) for r in whole])
            least = np.concatenate([np.frombuffer(r["more"], "<i8") for r in whole])
            first, low, of = _first_here(d.astype(">u8").view("S16").ravel(), least)
            late = np.flatnonzero(least > low[of]) if len(first) < len(d) else np.zeros(0, np.int64)
            cut = np.searchsorted(late, np.cumsum([0, *sizes]))
            for k, r in enumerate(whole):
                rows_ = late[cut[k] : cut[k + 1]]
                if len(rows_):
                    out.append((r["batch"], 1, pack(d[rows_][:, 0], d[rows_][:, 1])))
        if out:
            batch, kind, data = zip(*out)
            yield record(batch=batch, kind=kind, data=data)


def _said(answers: list[dict] | None, kind: int, *types: str) -> list[np.ndarray]:
    parts = [unpack(a["data"], *types) for a in answers or [] if a["kind"] == kind]
    return [np.concatenate(c) for c in zip(*parts)] if parts else [np.zeros(0, t) for t in types]


def _segments(buckets: int):
    """Batches and answers to rows: kind 0, a bucket's distinct segments; kind 1,
    where each stands in the batch, and which texts are gone whole."""

    def one(batch: int, docs: bytes, texts: bytes, answers) -> pa.RecordBatch:
        key, _, lens, text = opened(docs, texts)
        first, least, of = _first_here(_digests(text, lens), key)
        again = (key > least[of]) & (lens >= LEAST)
        gone = _said(answers, 1, "<u8", "<u8")
        if len(gone[0]):
            d = _hex(_digests(text, lens))
            late = {(a, b) for a, b in zip(*(g.tolist() for g in gone))}
            again |= np.fromiter(((a, b) in late for a, b in d.tolist()), bool, len(d))
        start, size, keys = runs(text, lens, again)
        doc = np.searchsorted(np.cumsum(lens), start, side="right")
        # Keys that two documents of this batch have are shared without asking.
        order = np.lexsort((doc, keys))
        new = np.ones(len(order), bool)
        new[1:] = keys[order][1:] != keys[order][:-1]
        group = np.cumsum(new) - 1
        edges = np.flatnonzero(new)
        last = np.append(edges[1:], len(order)) - 1
        several = np.zeros(len(keys), bool)
        many = np.zeros(len(keys), bool)
        if len(order):
            several[order] = (doc[order][edges] != doc[order][last])[group]
            many[order] = (_kinds(text, start, size, keys)[1] > HOT)[group]
        shared, hot = _said(answers, 0, "<u8", "?")
        by = np.argsort(shared, kind="stable")
        shared, hot = shared[by], hot[by]
        short = _short(keys, keys % np.uint64(buckets))
        at = np.minimum(np.searchsorted(shared, short), max(0, len(shared) - 1))
        asked = shared[at] == short if len(shared) else np.zeros(len(keys), bool)
        hot = np.where(asked, hot[at] if len(shared) else False, many)
        keep = asked | several
        start, size, keys, doc, hot = start[keep], size[keep], keys[keep], doc[keep], hot[keep]
        long_ = size + LEAST - 1
        content = np.zeros((len(start), RUN + LEAST), np.uint8)
        step = np.arange(RUN + LEAST - 1)
        for a in range(0, len(start), 4096):
            b = a + 4096
            place = np.minimum(start[a:b, None] + step, len(text) - 1)
            content[a:b, :-1] = np.where(step < long_[a:b, None], text[place], 0)
        content[:, -1] = long_
        kinds, some, j = np.unique(content.view(f"S{content.shape[1]}").ravel(), return_index=True, return_inverse=True) if len(start) else (np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64))
        del content
        # Numbered by where they first stand, so that numbers close by are sent together.
        place = np.argsort(some)
        number = np.empty(len(some), np.int64)
        number[place] = np.arange(len(some))
        some, j = some[place], number[j]
        low, high = np.full(len(kinds), NULL), np.full(len(kinds), np.iinfo(np.int64).min)
        np.minimum.at(low, j, key[doc])
        np.maximum.at(high, j, key[doc])
        # A segment is one item, or one for each window where its key is hot.
        n = np.where(hot[some], size[some], 1)
        item = np.repeat(np.arange(len(kinds)), n)
        base = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        single = hot[some][item]
        begin, length, route = start[some][item] + base, np.where(single, LEAST, long_[some][item]), keys[some][item]
        if single.any():
            word = _words(text)
            h = np.zeros(int(single.sum()), np.uint64)
            for w in range(0, LEAST - 7, 8):
                h = _mix((h ^ word[begin[single] + w]) * _M[0])
            route[single] ^= h
        bucket = ((route >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((begin, bucket))
        cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
        out = [((batch ^ batch >> 24) % buckets, 1, pack(start.astype("<i8"), doc.astype("<i4"), j.astype("<i4")), np.packbits(again).tobytes())]
        for k in np.flatnonzero(np.diff(cut)).tolist():
            rows = order[cut[k] : cut[k + 1]]
            n = length[rows]
            flat = text[np.arange(n.sum()) + np.repeat(begin[rows] - np.cumsum(n) + n, n)]
            out.append((k, 0, pack(np.diff(item[rows], prepend=0).astype("<i4"), base[rows].astype("u1"), n.astype("u1"), route[rows].astype("<u4"), low[item[rows]].astype("<i8"), (high - low)[item[rows]].astype("<i8")), squeeze(flat.tobytes(), 6)))
        k, kind, data, more = zip(*out)
        return record(bucket=k, kind=kind, batch=[batch] * len(k), data=data, more=more)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                yield one(*(b.column(c)[i].as_py() for c in range(4)))

    return run


def _distinct(flat: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct segments as a padded byte matrix, whose last byte is the length,
    and which of them each segment is.

    Slices are made distinct one by one, so a window that every batch has is
    one row and never a matrix of all its copies."""
    width = int(size.max()) + 1
    step, rows, of, held = np.arange(width - 1), [], [], 0
    for a in range(0, len(begin), _ROWS):
        n = size[a : a + _ROWS]
        body = np.zeros((len(n), width), np.uint8)
        body[:, :-1] = np.where(step < n[:, None], flat[np.minimum(begin[a : a + _ROWS, None] + step, len(flat) - 1)], 0)
        body[:, -1] = n
        kinds, where = np.unique(body.view(f"S{width}").ravel(), return_inverse=True)
        rows.append(kinds)
        of.append(where + held)
        held += len(kinds)
    rows, of = np.concatenate(rows), np.concatenate(of)
    if len(begin) > _ROWS:
        rows, where = np.unique(rows, return_inverse=True)
        of = where[of]
    return rows.view(np.uint8).reshape(-1, width), of


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A bucket's segments to spans for each batch that has them (kind 0); the
    batches' own places (kind 1) pass through."""
    for _, rows in by_bucket(batches):
        own = [r for r in rows if r["kind"] == 1]
        if own:
            yield record(batch=[r["batch"] for r in own], kind=[1] * len(own), data=[r["data"].to_pybytes() for r in own], more=[r["more"].to_pybytes() for r in own])
        rows = [r for r in rows if r["kind"] == 0]
        if not rows:
            continue
        cols = [unpack(r["data"], "<i4", "u1", "u1", "<u4", "<i8", "<i8") for r in rows]
        who = np.repeat(np.arange(len(rows)), [len(c[0]) for c in cols])
        j, base, size, route, low, high = (np.concatenate(c) for c in zip(*((np.cumsum(c[0], dtype="<i4"), *c[1:4], c[4], c[4] + c[5]) for c in cols)))
        size = size.astype(np.int64)
        flat = np.frombuffer(b"".join(unsqueeze(r["more"]) for r in rows), np.uint8)
        begin = np.cumsum(size) - size
        found: list[list] = [[] for _ in rows]
        held: list[tuple] = []

        def deal() -> None:
            """Spans of many arrays at once, so that work grows with spans, not with arrays times batches."""
            owner, *cols = (np.concatenate(c) for c in zip(*held))
            held.clear()
            sort = np.argsort(owner, kind="stable")
            owner, cols = owner[sort], [c[sort] for c in cols]
            ends = np.searchsorted(owner, np.arange(len(rows) + 1))
            for k in np.flatnonzero(np.diff(ends)).tolist():
                found[k].append(tuple(c[ends[k] : ends[k + 1]] for c in cols))

        order = np.argsort(route, kind="stable")
        sorted_route = route[order]
        done, many = 0, 0
        weight = np.cumsum((size - LEAST + 1)[order])
        while done < len(order):  # whole keys, until the array is large enough
            end = int(np.searchsorted(weight, (weight[done - 1] if done else 0) + SHARD)) + 1
            end = min(end, len(order))
            end = int(np.searchsorted(sorted_route, sorted_route[end - 1], side="right"))
            part = order[done:end]
            done = end
            kinds, of = _distinct(flat, begin[part], size[part])
            least, most = np.full(len(kinds), NULL), np.full(len(kinds), np.iinfo(np.int64).min)
            np.minimum.at(least, of, low[part])
            np.maximum.at(most, of, high[part])
            seg, off, length, doc = spans(kinds[:, :-1], kinds[:, -1].astype(np.int64), least, most)
            # Each row gets the spans of its content that are of use to it.
            by = np.argsort(seg, kind="stable")
            seg, off, length, doc = seg[by], off[by], length[by], doc[by]
            cut = np.searchsorted(seg, np.arange(len(kinds) + 1))
            n = np.diff(cut)[of]
            row = np.repeat(np.arange(len(part)), n)
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - cut[of], n)
            use = doc[at] < high[part][row]
            row, at = row[use], at[use]
            held.append((who[part][row].astype("<i4"), j[part][row], (off[at] + base[part][row]).astype("u1"), length[at].astype("u1"), doc[at]))
            many += len(row)
            if many >= FOUND:
                deal()
                many = 0
        if held:
            deal()
        out = [(r["batch"], pack(*(np.concatenate(c) for c in zip(*f)))) for r, f in zip(rows, found) if f]
        if out:
            batch, data = zip(*out)
            yield record(batch=batch, kind=[0] * len(batch), data=data, more=[None] * len(batch))


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _apply(text_at: int | None = None):
    """Results; or, with ``text_at``, the carried columns and at that place the
    text that is left, without bytes of characters that were cut apart."""

    def one(docs: bytes, texts: bytes, rest: bytes, where: bytes, gone: bytes, answers) -> pa.RecordBatch:
        key, null, lens, text = opened(docs, texts)
        start, doc, j = unpack(where, "<i8", "<i4", "<i4")
        change = np.zeros(len(text) + 1, np.int32)
        if answers and len(j):
            seg, off, length, least = (np.concatenate(c) for c in zip(*(unpack(a, "<i4", "u1", "u1", "<i8") for a in answers)))
            order = np.argsort(seg, kind="stable")
            cut = np.searchsorted(seg[order], np.arange(int(j.max()) + 2))
            n = np.diff(cut)[j]
            occ = np.repeat(np.arange(len(j)), n)
            at = order[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - cut[j], n)]
            use = least[at] < key[doc[occ]]
            begin = start[occ[use]] + off[at[use]]
            change += np.bincount(begin, minlength=len(change)).astype(np.int32)
            change -= np.bincount(begin + length[at[use]], minlength=len(change)).astype(np.int32)
        covered = np.cumsum(change[:-1]) > 0
        again = np.unpackbits(np.frombuffer(gone, np.uint8), count=len(lens)).astype(bool)
        ends = np.cumsum(lens)
        removed, pieces, kept = [], [], []
        for a, b, whole in zip((ends - lens).tolist(), ends.tolist(), again.tolist()):
            if whole:
                covered[a:b] = True
            c = covered[a:b]
            removed.append(int(c.sum()))
            pieces.append(int(c[:1].sum() + (c[1:] & ~c[:-1]).sum()) if removed[-1] else 0)
            left = text[a:b][~c] if removed[-1] else text[a:b]
            kept.append(left.tobytes().decode("utf-8", "ignore") if text_at is not None else hashlib.sha256(left).hexdigest())
        if text_at is not None:
            arrays = rest_columns(rest)
            arrays.insert(text_at, pa.array(kept, pa.string()))
            return pa.RecordBatch.from_arrays(arrays, [str(i) for i in range(len(arrays))])
        return pa.RecordBatch.from_arrays([pa.array(key, mask=null), pa.array(lens), pa.array(removed, pa.int64()), pa.array(pieces, pa.int64()), pa.array(kept, pa.string())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                yield one(*(b.column(c)[i].as_py() for c in range(6)))

    return run


def dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row of
    (doc_id, text)."""
    return _applied(docs, []).mapInArrow(lean(_apply()), RESULT)


def cleaned(docs: DataFrame) -> DataFrame:
    """All rows and columns of ``docs``, the texts without what was removed.
    A null text comes out empty."""
    at = docs.columns.index("text")
    rest = [c for i, c in enumerate(docs.columns) if i != at]
    return _applied(docs, rest).mapInArrow(lean(_apply(at)), docs.schema)


def _applied(docs: DataFrame, rest: list[str]) -> DataFrame:
    """Each stored batch with the spans found for it."""
    spark = docs.sparkSession
    with scratch() as keep:
        stored = keep(store_texts(docs, rest, BATCH))
        # A bucket has the segments of at most some 64 batches' worth of text.  Every batch
        # sends a message to every bucket, so of many batches a bucket has at least 8's worth.
        count = stored.count()
        buckets = max(count // 64, min(partitions(spark), max(256, count // 8)))
        message = "bucket int, kind int, batch long, data binary, more binary"
        # No name holds the shuffled frames, so their files go once they are written.
        told = written(to_buckets(stored.select("batch", "docs", "texts").mapInArrow(lean(_ask(buckets)), message), buckets).mapInArrow(lean(_answer), "batch long, kind int, data binary"), "keys", "uncompressed")
        tidy(spark)
        answers = at_batches(told, buckets).groupBy("batch").agg(F.collect_list(F.struct("kind", "data")).alias("answers"))
        found = keep(written(to_buckets(at_batches(stored, buckets).join(answers, "batch", "left").select("batch", "docs", "texts", "answers").mapInArrow(lean(_segments(buckets)), message), buckets).mapInArrow(lean(_search), "batch long, kind int, data binary, more binary"), "spans", "uncompressed"))
        del answers
        dropped(told)
        tidy(spark)
    where = at_batches(found.where("kind = 1"), buckets).select("batch", F.col("data").alias("at"), F.col("more").alias("gone"))
    found = at_batches(found.where("kind = 0"), buckets).groupBy("batch").agg(F.collect_list("data").alias("found"))
    last = at_batches(stored, buckets).join(where, "batch").join(found, "batch", "left")
    return last.select("docs", "texts", "rest", "at", "gone", "found")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
w AS (SELECT doc_id, unnest(range(greatest(0, length(x) // 2 - 49))) AS pos, x FROM d),
h AS (SELECT doc_id, pos, substr(x, 2 * pos + 1, 100) AS s FROM w),
f AS (SELECT doc_id, pos, min(doc_id) OVER (PARTITION BY s) < doc_id AS late FROM h),
l AS (SELECT doc_id, pos, lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) AS before FROM f WHERE late),
g AS (SELECT doc_id, pos, sum(CASE WHEN before IS NULL OR pos > before + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM l),
r AS (SELECT doc_id, run, min(pos) AS a, max(pos) + 50 AS b FROM g GROUP BY doc_id, run),
k AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS since FROM r),
o AS (SELECT d.doc_id, any_value(x) AS x, count(k.a) AS n_spans, coalesce(sum(k.b - k.a), 0)::BIGINT AS n_removed,
  coalesce(string_agg(substr(x, 2 * since + 1, 2 * (k.a - since)), '' ORDER BY k.a), '') AS kept, coalesce(max(k.b), 0) AS rest FROM d LEFT JOIN k ON k.doc_id = d.doc_id GROUP BY d.doc_id)
SELECT doc_id, length(x) // 2 AS n_bytes, n_removed, n_spans, sha256(unhex(kept || substr(x, 2 * rest + 1))) AS kept_sha256 FROM o
"""
