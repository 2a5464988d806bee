"""SentencePiece segmentations by forward filtering, backward sampling.

A text, with a virtual space in front, is cut where no piece of the
vocabulary can reach across: before the spaces that follow another character
(not at all if some piece holds a space after another character). The lattice
of such a run has an edge for every piece that matches, runs of spaces
included, and one for every character spelled in byte pieces, so each text has
a segmentation. An edge weighs ``temperature * log share`` of its piece;
shares follow the piece's rank.

Forward filtering sums the weights of all segmentations of every prefix;
backward sampling draws the last piece of a run given the sums, then the one
before it, and so on: exact draws from the lattice's distribution. Draws are
hashes of the seed, the row's key, the run's number and the step, so they
do not depend on partitions, order or retries.

The distinct runs of a slice of rows are worked on together: matching walks a
trie for all positions at once, sums advance by one end position for all runs,
and all runs draw together, an edge each at a time. A worker keeps the
lattices of runs it has met in a table of bounded size. A run of over ``LONG``
characters is filtered and drawn alone, window by window, whole: only its sums
are held, the edges of a window are found again on the way back.

Decoding joins pieces, turns the space sign to a space and drops the virtual
one. A space sign in the text itself is spelled in bytes, so decoding gives
every text back.

Null text counts as empty: no pieces, and it decodes to the empty text. A
null id has the key 0; rows that repeat an id and a text get the same
pieces. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tillroll.llm.common import id_and_text, slices, text_bytes

SIGN = "▁"
OWN_SIGN = 0x110000  # beyond Unicode: a space sign of the text itself
LONG = 2048  # characters; longer runs are worked on window by window
WINDOW = 1 << 15  # characters of a long run's window
AT_ONCE = 400_000  # characters of the runs worked on together
HELD = 6_000_000  # edges of remembered lattices, before a slice adds its own
TEMPERATURE = 1.0
DRAW_BITS = 40
SEED = 20240607
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Vocabulary:
    """A SentencePiece model's pieces as a trie over code points."""

    def __init__(self, path: str, temperature: float = TEMPERATURE):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(n)]
        special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(n)]
        self.byte_ids = np.zeros(256, np.int32)
        self.bytes_of: list[bytes] = []
        plain = []
        for i, name in enumerate(names):
            if model.is_byte(i):
                value = int(name[3:-1], 16)
                self.byte_ids[value] = i
                self.bytes_of.append(bytes([value]))
            else:
                self.bytes_of.append(b"" if special[i] else name.replace(SIGN, " ").encode())
                if not special[i]:
                    plain.append(i)
        order = sorted(plain, key=lambda i: (-model.get_score(i), i))
        weights = np.zeros(n)
        weights[order] = -np.log(10.0 + np.arange(len(order)))
        total = np.log(np.exp(weights[order]).sum())
        self.weight = temperature * (weights - total)
        self.byte_weight = temperature * (-np.log(10.0 + 4 * n) - total)
        nodes, ends = {}, [0]
        for i in plain:
            at = 0
            for c in names[i]:
                key = at << 21 | ord(c)
                if key not in nodes:
                    nodes[key] = len(ends)
                    ends.append(0)
                at = nodes[key]
            ends[at] = i
        self.keys = np.array(sorted(nodes), np.int64)
        self.next = np.array([nodes[k] for k in self.keys.tolist()], np.int64)
        self.ends = np.array(ends, np.int64)
        self.longest = max((len(names[i]) for i in plain), default=1)
        across = any(re.search(f"[^{SIGN}]{SIGN}", names[i]) for i in plain)
        self.runs = re.compile(r".+" if across else r" +[^ ]*", re.DOTALL)

    def edges(self, points: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Begin, length and piece of all matches; ``left`` counts the
        characters from a position to its run's end."""
        begin, length, piece = [], [], []
        at = np.arange(len(points))
        node = np.zeros(len(points), np.int64)
        step = 0
        while len(at):
            key = node << 21 | points[at + step]
            found = np.searchsorted(self.keys, key)
            found[found == len(self.keys)] = 0
            alive = self.keys[found] == key
            at, node = at[alive], self.next[found[alive]]
            step += 1
            ended = self.ends[node] > 0
            begin.append(at[ended])
            length.append(np.full(int(ended.sum()), step))
            piece.append(self.ends[node[ended]])
            more = left[at] > step
            at, node = at[more], node[more]
        return tuple(map(np.concatenate, (begin, length, piece)))


def _points(text: str) -> np.ndarray:
    """Code points as pieces write them. The text's own space signs become a
    point that no text or piece has."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    return np.where(points == ord(SIGN), OWN_SIGN, np.where(points == 32, ord(SIGN), points))


def _true(points: np.ndarray) -> np.ndarray:
    """The text's code points."""
    return np.where(points == OWN_SIGN, ord(SIGN), np.where(points == ord(SIGN), 32, points))


def _spelled(true: np.ndarray) -> np.ndarray:
    """Bytes of each code point in UTF-8."""
    return 1 + (true > 0x7F) + (true > 0x7FF) + (true > 0xFFFF)


def _parts(target: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Cumulated shares of each state's edges, as ``DRAW_BITS`` bits.
    Cumulated within each state alone, so a run's draws do not depend on what
    else is in the slice."""
    heads = np.flatnonzero(np.concatenate([[True], target[1:] != target[:-1]]))
    widths = np.diff(np.append(heads, len(target)))
    for rank in range(1, int(widths.max())):
        at = heads[widths > rank] + rank
        share[at] += share[at - 1]
    part = np.minimum(share * 2.0 ** DRAW_BITS, 2.0 ** DRAW_BITS - 2).astype(np.int64)
    part[heads + widths - 1] = (1 << DRAW_BITS) - 1
    return part


def _draws(key: np.ndarray, step: int) -> np.ndarray:
    """The draws of a step, of ``DRAW_BITS`` bits."""
    own = _mix(key + np.uint64((step + 1) * int(_GOLD) & (1 << 64) - 1))
    return (own >> np.uint64(64 - DRAW_BITS)).astype(np.int64) & ~1


class Sampler:
    def __init__(self, vocabulary: Vocabulary, seed: int = SEED):
        self.v = vocabulary
        self.seed = _mix(np.array([seed], np.uint64))
        self._forget()

    def _forget(self) -> None:
        """Empties the table of lattices."""
        self.known: dict[str, int] = {}
        kinds = {"last": np.int32, "goal": np.int32, "head": np.int32, "source": np.int32, "piece": np.int32,
                 "part": np.int64, "true": np.int32}
        self.table = {name: np.empty(1 << 16, kind) for name, kind in kinds.items()}
        self.used = dict.fromkeys(kinds, 0)

    def _remember(self, name: str, values: np.ndarray) -> None:
        held, n = self.table[name], self.used[name]
        if n + len(values) > len(held):
            self.table[name] = np.empty(max(len(held) * 3 // 2, n + len(values)), held.dtype)
            self.table[name][:n] = held[:n]
        self.table[name][n:n + len(values)] = values
        self.used[name] = n + len(values)

    def _numbers(self, runs: list[str]) -> np.ndarray:
        """Places of runs in the table; new ones are added."""
        if self.used["part"] > HELD:
            self._forget()
        new = [*dict.fromkeys(r for r in runs if r not in self.known)]
        if new:
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
            found = self.lattice(new)
            states, points = self.used["head"], self.used["true"]
            found["piece"] = np.where(found["piece"] < 0, found["piece"] - points, found["piece"])
            for name, offset in (("last", states), ("goal", states), ("source", states), ("head", self.used["part"]),
                                 ("piece", 0), ("part", 0), ("true", 0)):
                self._remember(name, found[name] + offset)
        return np.fromiter(map(self.known.__getitem__, runs), np.int64, len(runs))

    def _edges(self, points: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, ...]:
        """Begin, length, weight and piece of all edges; below zero, a
        character spelled in bytes."""
        begin, length, piece = self.v.edges(points, left)
        each = np.arange(len(points))
        weight = np.concatenate([self.v.weight[piece], self.v.byte_weight * _spelled(_true(points))])
        return (np.concatenate([begin, each]), np.concatenate([length, np.ones(len(each), np.int64)]), weight,
                np.concatenate([piece, -1 - each]))

    def lattice(self, runs: list[str]) -> dict[str, np.ndarray]:
        """Forward sums of all runs and, per state, its incoming edges in
        order with cumulated probabilities. A run of n characters has the
        states goal..goal+n."""
        sizes = np.fromiter(map(len, runs), np.int64, len(runs))
        points = _points("".join(runs))
        first = np.cumsum(sizes + 1) - (sizes + 1)
        run_of = np.repeat(np.arange(len(runs)), sizes)
        left = np.cumsum(sizes)[run_of] - np.arange(len(points))
        begin, length, weight, piece = self._edges(points, left)
        source = begin + run_of[begin]  # a state per character and one more per run
        target = source + length
        place = target - first[run_of[begin]]
        order = np.argsort((place << 44) + (target << 13) + (length << 1) + (piece < 0))  # no two are alike
        source, target, weight, piece, place = (x[order] for x in (source, target, weight, piece, place))
        sums = np.zeros(int(first[-1] + sizes[-1] + 1))
        cuts = np.searchsorted(place, np.arange(1, int(sizes.max()) + 2))
        for a, b in zip(cuts[:-1], cuts[1:]):
            heads = np.flatnonzero(np.concatenate([[True], target[a + 1:b] != target[a:b - 1]]))
            sums[target[a:b][heads]] = np.logaddexp.reduceat(sums[source[a:b]] + weight[a:b], heads)
        share = np.exp(sums[source] + weight - sums[target])
        order = np.argsort(target, kind="stable")
        source, target, share, piece = (x[order] for x in (source, target, share, piece))
        into = np.bincount(target, minlength=len(sums))
        return {"goal": first, "last": first + sizes, "source": source, "piece": piece, "true": _true(points),
                "sums": sums, "head": np.cumsum(into) - into, "part": _parts(target, share)}

    def draw(self, run: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Edges of a segmentation of each run asked for, in text order, and
        their number per run. ``key`` seeds a draw."""
        source, head, part = self.table["source"], self.table["head"], self.table["part"]
        state, goal = self.table["last"][run], self.table["goal"][run]
        who, taken, steps = np.arange(len(run)), [], 0
        counts = np.zeros(len(run), np.int64)
        while len(who):
            edge, draws = head[state], _draws(key[who], steps)
            late = np.flatnonzero(part[edge] <= draws)
            while len(late):
                edge[late] += 1
                late = late[part[edge[late]] <= draws[late]]
            taken.append((who, edge))
            counts[who] += 1
            state = source[edge]
            open_ = state > goal[who]
            who, state, steps = who[open_], state[open_], steps + 1
        ends = np.cumsum(counts)
        out = np.zeros(int(ends[-1]) if len(ends) else 0, np.int64)
        for step, (who, edge) in enumerate(taken):
            out[ends[who] - 1 - step] = edge
        return out, counts

    def _spell(self, pieces: np.ndarray, true: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces with characters spelled in bytes written out, and the number
        of ids of each run of ``counts`` pieces."""
        byte = pieces < 0
        width = np.ones(len(pieces), np.int64)
        points = true[-1 - pieces[byte]]
        width[byte] = _spelled(points)
        out = np.repeat(pieces, width)
        raw = points.astype("<u4").tobytes().decode("utf-32-le").encode()
        out[out < 0] = self.v.byte_ids[np.frombuffer(raw, np.uint8)]
        return out.astype(np.int32), np.add.reduceat(width, np.cumsum(counts) - counts)

    def _pieces(self, runs: list[str], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of the runs, and the number of ids of each."""
        edges, counts = self.draw(self._numbers(runs), keys)
        return self._spell(self.table["piece"][edges], self.table["true"], counts)

    def sums_of(self, points: np.ndarray) -> np.ndarray:
        """Forward sums of one run, found window by window."""
        n, longest = len(points), self.v.longest
        sums = np.full(n + 1, -np.inf)
        sums[0] = 0.0
        for a in range(0, n, WINDOW):
            b = min(n, a + WINDOW)
            near = points[a:b + longest]
            begin, length, weight, _ = self._edges(near, len(near) - np.arange(len(near)))
            order = np.argsort(begin, kind="stable")
            order = order[begin[order] < b - a]
            own = sums[a:b + longest + 1].tolist()
            for at, to, w in zip(begin[order].tolist(), (begin + length)[order].tolist(), weight[order].tolist()):
                w += own[at]
                old = own[to]
                own[to] = w if old == -math.inf else max(old, w) + math.log1p(math.exp(-abs(old - w)))
            sums[a:b + longest + 1] = own
        return sums

    def _long(self, run: str, key: np.uint64) -> tuple[np.ndarray, np.ndarray]:
        """``_pieces`` of one long run."""
        points = _points(run)
        sums, longest = self.sums_of(points), self.v.longest
        state, step, out = len(points), 0, []
        keys = np.array([key], np.uint64)
        for low in range((len(points) - 1) // WINDOW * WINDOW, -1, -WINDOW):
            a, high = max(0, low - longest), min(len(points), low + WINDOW)
            begin, length, weight, piece = self._edges(points[a:high], high - a - np.arange(high - a))
            target = begin + length + a
            order = np.lexsort((piece < 0, length, target))
            order = order[target[order] > low]
            source, target, piece = begin[order] + a, target[order], piece[order]
            part = _parts(target, np.exp(sums[source] + weight[order] - sums[target])).tolist()
            heads = np.searchsorted(target, np.arange(low + 1, high + 2)).tolist()
            source, piece = source.tolist(), np.where(piece < 0, piece - a, piece).tolist()
            while state > low:
                draw = int(_draws(keys, step)[0])
                edge = bisect_right(part, draw, heads[state - low - 1], heads[state - low])
                out.append(piece[edge])
                state, step = source[edge], step + 1
        return self._spell(np.array(out[::-1], np.int64), _true(points), np.array([len(out)]))

    def encode(self, ids: list[int | None], texts: list[str]) -> list[np.ndarray]:
        """Piece ids of each text."""
        found = [self.v.runs.findall(" " + text) if text else [] for text in texts]
        runs = [r for own in found for r in own]
        if not runs:
            return [np.empty(0, np.int32)] * len(texts)
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        base = np.array([(i or 0) & (2 ** 64 - 1) for i in ids], np.uint64)
        number = np.arange(len(runs)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        keys = _mix(np.repeat(_mix(base + self.seed), sizes) + number.astype(np.uint64) * _GOLD)
        lengths = np.fromiter(map(len, runs), np.int64, len(runs))
        ends, stops = np.cumsum(lengths), np.append(np.flatnonzero(lengths > LONG), len(runs)).tolist()
        at, stop, pieces, counts = 0, 0, [], []
        while at < len(runs):
            if at == stops[stop]:
                one, end, stop = self._long(runs[at], keys[at]), at + 1, stop + 1
            else:  # lattices of a bounded number of characters
                fit = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + AT_ONCE, "right"))
                end = min(stops[stop], max(at + 1, fit))
                one = self._pieces(runs[at:end], keys[at:end])
            pieces.append(one[0])
            counts.append(one[1])
            at = end
        pieces = np.concatenate(pieces)
        cuts = np.concatenate([[0], np.cumsum(np.concatenate(counts))])
        cuts = cuts[np.concatenate([[0], np.cumsum(sizes)])]
        return [pieces[a:b] for a, b in zip(cuts[:-1], cuts[1:])]


def decode_ids(vocabulary: Vocabulary, ids) -> bytes:
    """The text of a row of pieces, as UTF-8."""
    return b"".join(map(vocabulary.bytes_of.__getitem__, ids))[1:]


_SAMPLERS: dict[tuple, Sampler] = {}


def sampler(path: str, temperature: float, seed: int) -> Sampler:
    """The worker's sampler; workers live longer than tasks."""
    own = (path, temperature, seed)
    if own not in _SAMPLERS:
        _SAMPLERS[own] = Sampler(Vocabulary(path, temperature), seed)
    return _SAMPLERS[own]


def _encode_batches(path: str, temperature: float, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sampler(path, temperature, seed)
        for batch in batches:
            for rows in slices(batch, 1024, 3 << 20):
                found = own.encode(rows.column(0).to_pylist(), rows.column(1).to_pylist())
                offsets = np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found)))
                shas = [hashlib.sha256(t).hexdigest() for t in text_bytes(rows)]
                yield pa.RecordBatch.from_arrays([rows.column(0), lists, pa.array(shas)],
                                                 ["doc_id", "ids", "text_sha256"])

    return run


def sample_pieces(docs: DataFrame, path: str, temperature: float = TEMPERATURE, seed: int = SEED) -> DataFrame:
    """``doc_id, ids`` (a sampled segmentation) and ``text_sha256``, the
    checksum of the text it was made from."""
    return id_and_text(docs).mapInArrow(_encode_batches(path, temperature, seed),
                                        "doc_id long, ids array<int>, text_sha256 string")


def _decode_batches(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = sampler(path, TEMPERATURE, SEED).v
        for batch in batches:
            for rows in slices(batch, 1024, 3 << 20):
                lists = rows.column(1)
                values = lists.values.to_numpy()
                cuts = lists.offsets.to_numpy()
                texts = [decode_ids(vocabulary, values[a:b].tolist()) for a, b in zip(cuts[:-1], cuts[1:])]
                crc = [zlib.crc32(values[a:b].astype("<u4").tobytes()) for a, b in zip(cuts[:-1], cuts[1:])]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(np.diff(cuts).astype(np.int64)), pa.array(crc, pa.int64()),
                     pa.array(texts, pa.binary()).cast(pa.string()), rows.column(2)],
                    ["doc_id", "n_pieces", "ids_crc32", "text", "text_sha256"])

    return run


def decode_pieces(pieces: DataFrame, path: str) -> DataFrame:
    """The texts of ``sample_pieces``: ``doc_id, n_pieces, ids_crc32, text``
    (decoded) and ``text_sha256`` of the text that was encoded."""
    return pieces.mapInArrow(_decode_batches(path),
                             "doc_id long, n_pieces long, ids_crc32 long, text string, text_sha256 string")
