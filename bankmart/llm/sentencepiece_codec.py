"""SentencePiece encoding and decoding by a batched Viterbi in numpy.

The pieces and scores come from a public model file. A text is cut before every run of
spaces (no piece has a space after another character), and each distinct
part is segmented once a task: parts of like length advance together, the hashes of
their substrings probe the sorted hashes of the pieces, and for every end the best
last piece is stored as a back pointer.

For a unigram model the best is the largest sum of scores. For a BPE model
a sum of scores is not the model's segmentation. There a path counts only if every
two neighbours are what merging by score makes of their joined characters; exactly
one last piece does so at every end, and it is found from the longest
down. Neighbours are tested for whole arrays at once by undoing merges on both sides of the border.
A character that is no piece becomes its bytes' pieces.

Long parts (scripts without spaces, encoded data) are cut before they advance: first between
characters that stand next to each other in no piece, which no merge can cross; then, for a BPE model, into
overlapping windows that advance together. As only one path has all its neighbours in order, two windows may be
joined at any border that both have, if the piece before it in the one and the piece after it in
the other are neighbours in order, too. A part without such a border advances as a whole.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from .common import PartCache, SortedHashes, lean, mix64, ranges, shipped, slices, text_bytes

SLICE_BYTES = 4 << 20
BLOCK = 1 << 16               # parts that advance together
WINDOW, STEP = 128, 96        # of parts longer than twice a step
ROUNDS = 64                   # of moving windows before a part advances as a whole
SPACE = "▁"              # a space inside pieces (fixed value of the format)

_FACTOR = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Merges:
    """By id: how merging by score makes each piece."""

    rank: np.ndarray         # when its last merge happens; -1 for single characters
    left: np.ndarray         # the two pieces of its last merge
    right: np.ndarray
    sums: np.ndarray         # polynomial hash and factor of its characters
    factor: np.ndarray
    size: np.ndarray


@dataclass
class Pieces:
    """The vocabulary of a model file as arrays."""

    hashes: SortedHashes     # of the ordinary pieces' characters
    ids: np.ndarray          # in the order of the hashes
    scores: np.ndarray
    longest: int             # characters of the longest piece
    pairs: np.ndarray        # sorted: characters next to each other in some piece
    byte_ids: np.ndarray     # id of each byte's piece
    unknown: float           # score of a character that is no piece
    merges: Merges | None    # of a BPE model
    bytes_of: list           # what each id decodes to
    prefix: bool             # a text gets a leading space


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _FACTOR, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def _sum(chars: np.ndarray) -> np.ndarray:
    value = mix64(chars.astype(np.uint64) + np.uint64(1))
    return (value * _powers(chars.shape[1])).sum(1, dtype=np.uint64)


def _hash(chars: np.ndarray) -> np.ndarray:
    """Hash of every row of characters (n x length)."""
    return mix64(_sum(chars) + np.uint64(chars.shape[1]))


def _last_merge(name: str, names: dict, rank: dict) -> tuple | None:
    """The two pieces of the last merge, None if merging does not arrive at the piece."""
    symbols = list(name)
    while len(symbols) > 2:
        best = min((rank.get(names.get(a + b), 1 << 60), i)
                   for i, (a, b) in enumerate(zip(symbols, symbols[1:])))
        if best[0] == 1 << 60:
            return None
        i = best[1]
        symbols = [*symbols[:i], symbols[i] + symbols[i + 1], *symbols[i + 2:]]
    return tuple(symbols) if all(x in names for x in symbols) else None


def load_pieces(path: str, kind: str = "bpe") -> Pieces:
    """Read a model file (``kind`` bpe or unigram) with byte fallback and without text normalisation."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    ordinary = [i for i in range(n) if not (model.is_control(i) or model.is_unknown(i)
                                            or model.is_byte(i) or model.is_unused(i))]
    names = {i: model.id_to_piece(i) for i in ordinary}
    merges = None
    if kind == "bpe":
        own = {name: i for i, name in names.items()}
        order = sorted(ordinary, key=lambda i: (-model.get_score(i), i))
        turn = {i: r for r, i in enumerate(order)}
        made = {i: _last_merge(names[i], own, turn) for i in ordinary if len(names[i]) > 1}
        names = {i: x for i, x in names.items() if len(x) == 1 or made[i]}    # others never come up
        ordinary = list(names)
        merges = Merges(*(np.full(n, -1, np.int64) for _ in range(3)), np.zeros(n, np.uint64),
                        np.ones(n, np.uint64), np.ones(n, np.int64))
        for i, name in names.items():
            if len(name) > 1:
                merges.rank[i] = turn[i]
                merges.left[i], merges.right[i] = (own[x] for x in made[i])
    by_length: dict[int, list[int]] = {}
    for i in ordinary:
        by_length.setdefault(len(names[i]), []).append(i)
    hashes, ids = [], []
    for length, own in by_length.items():
        chars = np.frombuffer("".join(names[i] for i in own).encode("utf-32-le"), np.uint32)
        chars = chars.reshape(-1, length)
        hashes.append(_hash(chars))
        ids += own
        if merges is not None:
            merges.sums[own] = _sum(chars)
            merges.factor[own] = _powers(length + 1)[length]
            merges.size[own] = length
    hashes = np.concatenate(hashes)
    order = np.argsort(hashes)
    ids = np.array(ids, np.int64)[order]
    scores = np.array([model.get_score(int(i)) for i in ids])
    byte_ids = np.full(256, model.unk_id(), np.int64)
    bytes_of = [b""] * n
    for i in range(n):
        if model.is_byte(i):
            value = int(model.id_to_piece(i)[3:-1], 16)
            byte_ids[value], bytes_of[i] = i, bytes([value])
        elif i in names:
            bytes_of[i] = names[i].replace(SPACE, " ").encode()
    pairs = {(ord(a) << 21) + ord(b) for name in names.values() for a, b in zip(name, name[1:])}
    return Pieces(SortedHashes(hashes[order]), ids, scores, max(by_length),
                  np.array(sorted(pairs), np.uint64), byte_ids,
                  float(scores.min()) - 10.0, merges, bytes_of, model.encode("a", out_type=str)[0][0] == SPACE)


def stays_apart(one: np.ndarray, two: np.ndarray, pieces: Pieces) -> np.ndarray:
    """Whether merging the characters of pieces ``one`` and ``two`` together ends with these two.

    Merges are undone in reverse order on both sides of the border. The two symbols at
    the border after each step existed together until the merge just undone; if they could
    have merged earlier than that, the pieces do not stay apart.
    """
    m = pieces.merges
    out = np.ones(len(one), bool)
    # twice the rank, plus one where a merge at the border wins a tie because it is further left
    limit = np.full(len(one), 1 << 60, np.int64)
    left = np.arange(len(one))
    while len(left):
        at = pieces.hashes.find(mix64(m.sums[one] + m.factor[one] * m.sums[two]
                                      + (m.size[one] + m.size[two]).astype(np.uint64)))
        joined = np.where(at >= 0, 2 * m.rank[pieces.ids[at]], 1 << 61)
        bad = joined < limit
        out[left[bad]] = False
        go = ~bad & ((m.rank[one] >= 0) | (m.rank[two] >= 0))
        left, one, two = left[go], one[go], two[go]
        first = m.rank[one] > m.rank[two]
        limit = np.where(first, 2 * m.rank[one], 2 * m.rank[two] + 1)
        one, two = np.where(first, m.right[one], one), np.where(first, two, m.left[two])
    return out


def segment(chars: np.ndarray, sizes: np.ndarray, pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Viterbi over parts (n x longest characters) of falling ``sizes``; those that are long enough advance together.

    Returns (ids from the end, -1 - character where no piece fits; number of ids per part).
    """
    n, length = chars.shape
    power = _powers(length + 1)
    sums = np.zeros((length + 1, n), np.uint64)
    np.cumsum(mix64(chars.T.astype(np.uint64) + np.uint64(1)) * power[:length, None], axis=0, out=sums[1:])
    inverse = np.full(length + 1, np.uint64(pow(int(_FACTOR), -1, 2**64)), np.uint64)
    inverse[0] = 1
    inverse = np.cumprod(inverse, dtype=np.uint64)
    back = np.zeros((length + 1, n), np.int16)
    which = np.full((length + 1, n), -1, np.int64)
    best = np.zeros((length + 1, n)) if pieces.merges is None else None
    every = np.arange(n)
    active = np.searchsorted(-sizes, -np.arange(length + 1), side="right")    # parts that reach a place

    def probe(rows, start, end):
        """Places of the pieces that the characters start..end are, and which of the rows have one."""
        at = pieces.hashes.find(mix64((sums[end, rows] - sums[start, rows]) * inverse[start]
                                      + np.uint64(end - start)))
        hit = np.flatnonzero(at >= 0)
        return at[hit], hit

    for end in range(1, length + 1):
        rows = every[:active[end]]
        # until a piece is found: the last character by itself
        which[end, rows], back[end, rows] = -1 - chars[rows, end - 1].astype(np.int64), 1
        spans = range(min(end, pieces.longest), 0, -1)
        if best is None:
            for span in spans:
                at, hit = probe(rows, end - span, end)
                if not len(hit):
                    continue
                found, piece = rows[hit], pieces.ids[at]
                good = np.full(len(hit), end == span)
                if end > span:
                    before = which[end - span, found]
                    test = before >= 0
                    good = ~test         # after a character that is no piece nothing merges
                    good[test] = stays_apart(before[test], piece[test], pieces)
                which[end, found[good]], back[end, found[good]] = piece[good], span
                rows = np.delete(rows, hit[good])
                if not len(rows):
                    break
            continue
        best[end, rows] = best[end - 1, rows] + pieces.unknown
        for span in spans:
            at, hit = probe(rows, end - span, end)
            found = rows[hit]
            score = best[end - span, found] + pieces.scores[at]
            better = score > best[end, found]
            if span == 1:                # where a character is a piece, it is not unknown
                better |= which[end, found] < 0
            best[end, found[better]] = score[better]
            which[end, found[better]], back[end, found[better]] = pieces.ids[at[better]], span
    out = np.zeros((n, length), np.int64)
    count = np.zeros(n, np.int64)
    at = sizes.copy()
    left = np.flatnonzero(at > 0)
    while len(left):
        out[left, count[left]] = which[at[left], left]
        count[left] += 1
        at[left] -= back[at[left], left]
        left = left[at[left] > 0]
    return out, count


def _segmented(chars: np.ndarray, begin: np.ndarray, size: np.ndarray, pieces: Pieces):
    """Yield (numbers of parts, ids in order as a matrix, numbers of ids) of the parts chars[begin:begin + size].

    Parts of like length advance together: up to 8 characters, up to 16, and so on.
    """
    order = np.argsort(-size, kind="stable")
    level = np.ceil(np.log2(np.maximum(size[order], 8))).astype(np.int64)
    for a, z in _runs(level):
        block = max(1, min(BLOCK, (1 << 20) // int(size[order[a]])))
        for b in range(a, z, block):
            own = order[b:min(z, b + block)]
            n = int(size[own[0]])
            at = np.minimum(begin[own][:, None] + np.arange(n), len(chars) - 1)    # what is beyond a part is not read
            ids, count = segment(chars[at], size[own], pieces)
            # reversed: the ids come from the end of a part
            turn = np.where(np.arange(n) < count[:, None], count[:, None] - 1 - np.arange(n), 0)
            yield own, np.take_along_axis(ids, turn, 1), count


def _windows(chars: np.ndarray, start: np.ndarray, size: np.ndarray, pieces: Pieces):
    """Segments of the windows chars[start:start + size]: (ids in order, characters of each; 0 after the last)."""
    token, width = np.zeros((len(start), WINDOW), np.int64), np.zeros((len(start), WINDOW), np.int64)
    for own, ids, count in _segmented(chars, start, size, pieces):
        n = ids.shape[1]
        token[own, :n] = ids
        width[own, :n] = np.where(np.arange(n) < count[:, None],
                                  np.where(ids >= 0, pieces.merges.size[ids], 1), 0)
    return token, width


def segment_windows(chars: np.ndarray, begin: np.ndarray, length: np.ndarray, pieces: Pieces) -> dict:
    """Long parts of a BPE model, chars[begin:begin + length] each, by windows.

    Returns by number of the part its ids in order (-1 - character where no piece fits). Where
    neighbouring windows have no border to be joined at (a run whose pieces start elsewhere), the windows from there on are
    moved to a border of the one before. Parts that need too many moves are not in the result.
    """
    def laid(at, n):
        return np.arange(at, max(at + 1, n - (WINDOW - STEP)), STEP)

    starts = {p: laid(0, n) for p, n in enumerate(length.tolist())}
    out: dict = {}
    moved: dict = {p: (-1, 0) for p in starts}
    for _ in range(ROUNDS):
        if not starts:
            break
        parts = np.array(list(starts))
        many = [len(starts[p]) for p in parts]
        owner, start = np.repeat(np.arange(len(parts)), many), np.concatenate([starts[p] for p in parts])
        size = np.minimum(WINDOW, length[parts][owner] - start)
        token, width = _windows(chars, begin[parts][owner] + start, size, pieces)
        end = np.cumsum(width, axis=1)
        row, j = np.nonzero(width)
        before = np.full((len(start), WINDOW + 1), -1, np.int64)     # number of the token that ends, or begins, here
        after = before.copy()
        before[row, end[row, j]] = j
        after[row, end[row, j] - width[row, j]] = j
        one = np.flatnonzero(owner[:-1] == owner[1:])                # with the window after it
        gap = start[one + 1] - start[one]
        place = np.arange(WINDOW + 1)
        there = np.take_along_axis(after[one + 1], np.maximum(place - gap[:, None], 0), 1)
        pair, at = np.nonzero((before[one] >= 0) & (there >= 0) & (place >= gap[:, None]))
        x, y = token[one[pair], before[one[pair], at]], token[one[pair] + 1, there[pair, at]]
        fits = (x < 0) | (y < 0)
        fits[~fits] = stays_apart(x[~fits], y[~fits], pieces)
        joint = np.full(len(one), WINDOW + 1)
        np.minimum.at(joint, pair[fits], at[fits])
        missing = joint > WINDOW
        first, last = np.zeros(len(start), np.int64), size.copy()
        last[one], first[one + 1] = joint, joint - gap
        keep = (width > 0) & (end - width >= first[:, None]) & (end <= last[:, None])
        open_ = np.zeros(len(parts), bool)
        open_[owner[one[missing]]] = True
        bounds = np.append(0, np.cumsum(many))
        for i in np.flatnonzero(~open_).tolist():
            rows = slice(bounds[i], bounds[i + 1])
            out[int(parts[i])] = token[rows][keep[rows]]
            del starts[int(parts[i])]
        wrong = one[missing]
        for i in np.flatnonzero(open_).tolist():
            p = int(parts[i])
            k = int(wrong[np.searchsorted(wrong, bounds[i])])        # the first pair that does not join
            borders = np.flatnonzero(before[k, STEP - WINDOW // 4:size[k]] >= 0) + STEP - WINDOW // 4
            tries = moved[p][1] + 1 if moved[p][0] == k - bounds[i] else 0
            moved[p] = (k - bounds[i], tries)
            if tries >= len(borders):
                del starts[p]
            else:
                starts[p] = np.append(starts[p][:k - bounds[i] + 1], laid(int(start[k] + borders[tries]), int(length[p])))
    return out


class Codec:
    """Encodes and decodes many texts at once."""

    def __init__(self, pieces: Pieces):
        import pyarrow as pa

        self.pieces = pieces
        self.decoded = pa.array(pieces.bytes_of, pa.large_binary())
        self.cache = PartCache(self._words)

    def _words(self, words: list) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all parts, sizes) of a list of parts."""
        whole = np.fromiter(map(len, words), np.int64, len(words))
        joined = np.frombuffer("".join(words).replace(" ", SPACE).encode("utf-32-le"), np.uint32)
        # cut between characters that no piece holds together
        cut = np.zeros(len(joined), bool)
        cut[np.cumsum(whole) - whole] = True
        beside = (joined[:-1].astype(np.uint64) << np.uint64(21)) + joined[1:]
        place = np.minimum(np.searchsorted(self.pieces.pairs, beside), len(self.pieces.pairs) - 1)
        cut[1:] |= self.pieces.pairs[place] != beside if len(self.pieces.pairs) else True
        begin = np.flatnonzero(cut)
        size = np.diff(np.append(begin, len(joined)))
        owner = np.repeat(np.arange(len(words)), whole)[begin]
        rows: list = []
        counts = np.zeros(len(size), np.int64)

        def put(part, flat, count):
            flat, count = self._bytes(flat, count)
            counts[part] = count
            rows.append((part, flat, count))

        long = 2 * STEP if self.pieces.merges is not None else len(joined)
        some = np.flatnonzero(size > long)
        alone = size > long
        for a in range(0, len(some), 1 << 10):
            part = some[a:a + (1 << 10)]
            for p, ids in segment_windows(joined, begin[part], size[part], self.pieces).items():
                put(part[p:p + 1], ids, np.array([len(ids)]))
                alone[part[p]] = False
        rest = np.flatnonzero((size <= long) | alone)
        for own, ids, count in _segmented(joined, begin[rest], size[rest], self.pieces):
            put(rest[own], ids[np.arange(ids.shape[1]) < count[:, None]], count)
        start = np.cumsum(counts) - counts
        out = np.zeros(int(counts.sum()), np.int32)
        for part, flat, count in rows:
            out[np.repeat(start[part] - (np.cumsum(count) - count), count) + np.arange(len(flat))] = flat
        return out, np.bincount(owner, counts, len(words)).astype(np.int64)

    def _bytes(self, flat: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters without a piece as the pieces of their bytes."""
        odd = np.flatnonzero(flat < 0)
        if not len(odd):
            return flat, count
        owner = np.repeat(np.arange(len(count)), count)
        coded = [self.pieces.byte_ids[list(chr(-1 - c).encode())] for c in flat[odd].tolist()]
        width = np.ones(len(flat), np.int64)
        width[odd] = [len(c) for c in coded]
        out = np.repeat(flat, width)
        owner = np.repeat(owner, width)
        out[out < 0] = np.concatenate(coded)
        return out, np.bincount(owner, minlength=len(count))

    def encode(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts as int32, n + 1 offsets); a null or empty text has none."""
        import pyarrow as pa

        raw, offsets = text_bytes(texts)
        n = len(offsets) - 1
        if not len(raw):
            return np.zeros(0, np.int32), np.zeros(n + 1, np.int64)
        if self.pieces.prefix:       # a space before every text that is not empty
            begin = offsets[:-1][np.diff(offsets) > 0]
            raw = np.insert(raw, begin, 0x20)
            offsets = offsets + np.searchsorted(begin, offsets)
        space = raw == 0x20
        cut = space.copy()
        cut[1:] &= ~space[:-1]
        cut[offsets[:-1][np.diff(offsets) > 0]] = True
        cuts = np.append(np.flatnonzero(cut), len(raw))
        raw = pa.py_buffer(np.ascontiguousarray(raw))
        ids, sizes, a = [], [], 0
        while a < len(cuts) - 1:         # a bounded stretch of parts at a time
            z = max(a + 1, int(np.searchsorted(cuts, cuts[a] + SLICE_BYTES, side="right")) - 1)
            parts = pa.LargeStringArray.from_buffers(
                z - a, pa.py_buffer(cuts[a:z + 1].astype(np.int64)), raw).dictionary_encode()
            index = parts.indices.to_numpy(zero_copy_only=False)
            flat, begin, size = self.cache.of(parts.dictionary.to_pylist())
            ids.append(ranges(flat, begin[index], size[index]))
            sizes.append(size[index])
            a = z
        ends = np.append(0, np.cumsum(np.concatenate(sizes)))
        return np.concatenate(ids), ends[np.searchsorted(cuts[:-1], offsets)]

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """The UTF-8 bytes of each text."""
        made = self.decoded.take(np.asarray(ids, np.int64))
        where = np.frombuffer(made.buffers()[1], np.int64)[:len(made) + 1]
        data = (made.buffers()[2] or b"")
        data = memoryview(data)
        skip = 1 if self.pieces.prefix else 0
        return [bytes(data[where[a] + skip:where[z]]) if z > a else b"" for a, z in zip(ends[:-1], ends[1:])]


def _runs(values: np.ndarray):
    """(begin, end) of every run of equal values."""
    if len(values):
        edge = np.flatnonzero(np.diff(values)) + 1
        yield from zip(np.r_[0, edge].tolist(), np.r_[edge, len(values)].tolist())


def encode_documents(documents: DataFrame, model: str) -> DataFrame:
    """Encode every whole text: doc_id, ids, n_pieces, ids_crc32, decoded_crc32, round_trip per row.

    ``model`` is the path of a SentencePiece model that the driver has. ``ids_crc32`` is over the ids as
    little-endian unsigned 32-bit integers; ``decoded_crc32`` over the UTF-8 text that decoding the ids gives;
    ``round_trip`` says that it is the text itself (it is not if the text has U+2581, which
    decodes to a space). Null and empty texts have no ids and decode to the empty text.
    Repeated rows give repeated rows. Other columns are ignored.
    """
    load = shipped(documents.sparkSession, load_pieces(model))   # fixed size

    def run(batches):
        import pyarrow as pa

        codec = Codec(load())
        for batch in batches:
            for part in slices(batch, SLICE_BYTES):
                ids, ends = codec.encode(part.column("text"))
                raw, offsets = text_bytes(part.column("text"))
                raw = memoryview(np.ascontiguousarray(raw))
                texts = codec.decode(ids, ends)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(pa.int64()),
                     pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids)),
                     pa.array(np.diff(ends)),
                     pa.array([zlib.crc32(ids[a:z].astype("<u4")) for a, z in zip(ends[:-1], ends[1:])],
                              pa.int64()),
                     pa.array([zlib.crc32(t) for t in texts], pa.int64()),
                     pa.array([t == raw[a:z] for t, a, z in zip(texts, offsets[:-1], offsets[1:])])],
                    ["doc_id", "ids", "n_pieces", "ids_crc32", "decoded_crc32", "round_trip"])

    return documents.select("doc_id", "text").mapInArrow(
        lean(run), "doc_id long, ids array<int>, n_pieces long, ids_crc32 long, decoded_crc32 long, round_trip boolean")


def decode_documents(encoded: DataFrame, model: str) -> DataFrame:
    """doc_id and text of rows (doc_id, ids); null ids give the empty text, bytes that are no UTF-8 U+FFFD."""
    load = shipped(encoded.sparkSession, load_pieces(model))

    def run(batches):
        import pyarrow as pa

        codec = Codec(load())
        for batch in batches:
            ids = batch.column("ids")
            sizes = np.array([len(x) if x is not None else 0 for x in ids.to_pylist()], np.int64)
            texts = codec.decode(ids.flatten().to_numpy(), np.append(0, np.cumsum(sizes)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()),
                 pa.array([t.decode("utf-8", "replace") for t in texts], pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
