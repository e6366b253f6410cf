"""Best-fit packing of token sequences by a configuration linear program.

Documents are tokenized, ended with one id and cut into pieces only where longer than the capacity. The histogram of piece lengths
(at most ``capacity`` numbers, whatever the input) goes to the driver. There the configuration linear program (how much of each way to
fill a bin, so that all pieces are covered, with the fewest bins) is solved by multiplicative weights: each length's weight is
multiplied down as it is covered, and the next configuration is the best knapsack filling for the present weights (dynamic programming
over the capacity). The solution is moved to a vertex over the configurations found, so few amounts are fractional, and rounded down;
what that leaves is solved again. Where there are many lengths, the program's rows are classes of the long ones (sized by their
longest) and the short pieces are kept for the end. The rest goes best-fit into the bins' room, and to bins of its own.
The plan has a bounded number of rows (distinct configurations times their slots); pieces look up their place in it by length and
rank within the length. Ranks come from counts per (salt, length) and a running sum, so no length is gathered in one task.

Tokenizing keeps a bounded cache from a text's pieces to their ids (see Encoder); the tokenizer's rules do not reach across pieces.

Edge cases: a null or empty text is the end id alone; an empty table gives no rows; a null id is kept as null; repeated rows are
packed each; other columns are neither read nor kept.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import Scratch, slices

CAPACITY, END = 4096, 1


#: Fixed values, of the tokenizer's rules within U+0000-U+00FF: letters and numbers (after lower-casing), and what splits off.
_LETTERS, _NUMBERS = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe"
_PIECE = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^ \t-\r{_LETTERS}{_NUMBERS}]+")
#: Characters of that range whose treatment as white space differs between libraries; texts that have one take the plain way.
_ODD = bytes([*range(9), *range(14, 32), *range(127, 161)])


def _byte_letters() -> list[str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others for the characters from U+0100 on, in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in plain else next(others)) for b in range(256)]


class Encoder:
    """Ids of whole texts, as the tokenizer in the file gives them. most: strings that the cache holds.

    Texts within Latin-1 are split by the tokenizer's own rules and each distinct piece goes through its merges once. Others are
    split at white space, which the tokenizer drops, and each distinct string goes through the whole tokenizer once.
    """

    def __init__(self, path: str, most: int = 300_000):
        from tokenizers import Tokenizer

        self.tok, self.most, self.letters = Tokenizer.from_file(path), most, _byte_letters()
        self.model = self.tok.model
        self.clear()

    def clear(self) -> None:
        self.at: dict[str | bytes, int] = {}
        self.ids, self.starts, self.used, self.n = np.zeros(1 << 16, np.uint32), np.zeros(1 << 12, np.int64), 0, 0

    def _merged(self, piece: str) -> list[int]:
        if not piece.isascii():
            piece = "".join([self.letters[b] for b in piece.encode()])
        return [t.id for t in self.model.tokenize(piece)]

    def _learn(self, new: list[str | bytes]) -> None:
        flat: list[int] = []
        ends = []
        for w in new:
            flat += self._merged(w) if isinstance(w, str) else self.tok.encode(w.decode("utf-8", "surrogatepass"), add_special_tokens=False).ids
            ends.append(len(flat))
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while self.n + len(new) + 1 > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
        self.ids[self.used : self.used + len(flat)] = flat
        self.starts[self.n + 1 : self.n + 1 + len(new)] = np.array(ends) + self.used
        self.at.update(zip(new, range(self.n, self.n + len(new)), strict=True))
        self.used, self.n = self.used + len(flat), self.n + len(new)

    def _split(self, text: str) -> list:
        try:
            raw = text.encode("latin-1")
        except UnicodeEncodeError:
            raw = None
        if raw is None or "<|" in text or len(raw.translate(None, _ODD)) != len(raw):
            return text.encode("utf-8", "surrogatepass").split()
        return _PIECE.findall(text.lower())

    def encode(self, text: str | None) -> np.ndarray:
        parts = self._split(text) if text else []
        if not parts:
            return np.empty(0, np.uint32)
        try:
            k = np.fromiter(map(self.at.__getitem__, parts), np.int64, len(parts))
        except KeyError:
            new = list(dict.fromkeys([w for w in parts if w not in self.at]))
            if self.n and self.n + len(new) > self.most:
                self.clear()
                new = list(dict.fromkeys(parts))
            self._learn(new)
            k = np.fromiter(map(self.at.__getitem__, parts), np.int64, len(parts))
        lo = self.starts[k]
        lens = self.starts[k + 1] - lo
        ends = np.cumsum(lens)
        return self.ids[np.repeat(lo - (ends - lens), lens) + np.arange(ends[-1])]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 for every row of docs."""

    def run(batches):
        enc = Encoder(tokenizer)
        for b in slices(batches):
            ids = b.column(0).to_pylist()
            out: list[list] = [[], [], [], [], []]
            for doc, text in zip(ids, b.column(1).to_pylist(), strict=True):
                t = np.append(enc.encode(text), np.uint32(end)).astype("<u4")
                for i, at in enumerate(range(0, len(t), capacity)):
                    part = t[at : at + capacity]
                    for col, v in zip(out, (doc, i, at, len(part), zlib.crc32(part.tobytes())), strict=True):
                        col.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.int64()), pa.array(out[4], pa.int64())], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


@dataclass
class Plan:
    """Slots, sorted by (length, first rank): pieces of a length with ranks from ``rank`` on go to sequences from ``seq`` on, at ``offset``."""

    length: np.ndarray
    rank: np.ndarray
    seq: np.ndarray
    offset: np.ndarray
    sequences: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = self.length.astype(np.int64) << 44 | self.rank
        at = np.searchsorted(key, length.astype(np.int64) << 44 | rank, "right") - 1
        return self.seq[at] + rank - self.rank[at], self.offset[at]


def _lots(lengths: np.ndarray, most: np.ndarray) -> list[tuple[int, int]]:
    """Each length as lots of 1, 2, 4, ... and the rest, so that taking lots or not gives any number up to ``most``."""
    out = []
    for k, more in enumerate(most.tolist()):
        lot = 1
        while more > 0:
            lot = min(lot, more)
            out.append((k, lot))
            more, lot = more - lot, 2 * lot
    return out


def _best_filling(weight: np.ndarray, lengths: np.ndarray, left: np.ndarray, capacity: int) -> np.ndarray:
    """Bounded knapsack: the multiset of lengths (as indices), of each no more than are left, of greatest total weight within the capacity.

    Lengths of which a bin could hold no more than are left are filled in without a bound where lots would be many; the others in lots
    of 1, 2, 4, ... and the rest, each lot taken once or not.
    """
    value, take = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    room = capacity // lengths
    free = left >= room
    if np.log2(room[free] + 1).sum() < 1500:
        free[:] = False
    at = np.flatnonzero(free)
    if len(at):
        size, gain = lengths[at], weight[at]
        fits = np.searchsorted(size, np.arange(capacity + 1), "right")
        for c in range(int(size[0]), capacity + 1):
            k = fits[c]
            got = value[c - size[:k]] + gain[:k]
            i = int(got.argmax())
            if got[i] > value[c - 1]:
                value[c], take[c] = got[i], at[i]
            else:
                value[c] = value[c - 1]
    rest = np.flatnonzero(~free)
    chosen: list[tuple[int, int, np.ndarray]] = []
    for j, lot in _lots(lengths[rest], np.minimum(left, room)[rest]):
        k = int(rest[j])
        size, got = lot * int(lengths[k]), value.copy()
        np.maximum(value[size:], value[: capacity + 1 - size] + lot * weight[k], out=got[size:])
        chosen.append((k, lot, got > value))
        value = got
    out, c = [], capacity
    for k, lot, better in reversed(chosen):
        if better[c]:
            out += [k] * lot
            c -= lot * int(lengths[k])
    while c > 0:
        if take[c] < 0:
            c -= 1
        else:
            out.append(int(take[c]))
            c -= int(lengths[take[c]])
    return np.array(out, np.int64)


def fractional(lengths: np.ndarray, count: np.ndarray, capacity: int, rounds: int, eta: float = 0.5) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray, float]:
    """The covering program min sum(x), sum of x * configuration >= count, by multiplicative weights.

    Returns configurations (indices, times), their amounts x, and the greatest dual bound met: for any weights, their sum over all
    pieces divided by the best filling's weight is a lower bound on the number of bins. A length's weight starts in proportion to the
    length and is multiplied, each time that a configuration covers a share of its pieces, by exp(-eta * share).
    """
    log_w, covered, bound = np.log(lengths / capacity), np.zeros(len(lengths)), 0.0
    step = 4 * max(1.0, float((lengths * count).sum()) / capacity) / rounds  # all pieces are covered about four times
    found: dict[tuple, list] = {}
    for _ in range(rounds):
        w = np.exp(log_w)
        kinds, times = np.unique(_best_filling(w, lengths, count, capacity), return_counts=True)
        bound = max(bound, float((w * count).sum() / (w[kinds] * times).sum()))
        use = min(step, float((count[kinds] / times).min()))
        share = use * times / count[kinds]
        covered[kinds] += share
        log_w[kinds] -= eta * share
        found.setdefault((*kinds, *times), [kinds, times, 0.0])[2] += use
    some = covered > 0
    return [(k, t) for k, t, _ in found.values()], np.array([x for *_, x in found.values()]) / (float(np.median(covered[some])) or 1.0), bound


def vertex(configs: list[tuple[np.ndarray, np.ndarray]], count: np.ndarray, lengths: np.ndarray, capacity: int, most: int = 4000) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """Crossover: the best vertex of the program restricted to these configurations (and one of each length alone), by primal simplex.
    At most as many configurations as lengths are left."""
    m = len(lengths)
    alone = np.minimum(capacity // lengths, count)
    pool = [(np.array([i]), np.array([int(a)])) for i, a in enumerate(alone)] + configs
    a = np.zeros((m, len(pool)))
    for j, (k, t) in enumerate(pool):
        a[k, j] = t
    need = count + 1e-7 * np.arange(1, m + 1)  # no ties in the ratio test
    base, inverse = list(range(m)), np.diag(1.0 / alone)
    for _ in range(most):
        cost = np.array([0.0 if j >= len(pool) else 1.0 for j in base])
        dual, x = cost @ inverse, inverse @ need
        gain = np.concatenate([dual @ a - 1.0, -dual])
        j = int(gain.argmax())
        if gain[j] < 1e-9:
            break
        column = inverse @ a[:, j] if j < len(pool) else -inverse[:, j - len(pool)]
        can = np.flatnonzero(column > 1e-9)
        if not len(can):
            break
        r = int(can[(x[can] / column[can]).argmin()])
        pivot = inverse[r] / column[r]
        inverse -= np.outer(column, pivot)
        inverse[r] = pivot
        base[r] = j
    x = inverse @ count
    return [(*pool[j], float(v)) for j, v in zip(base, x, strict=True) if j < len(pool) and v > 1e-9]


def classes(lengths: np.ndarray, count: np.ndarray, capacity: int, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Which lengths the program covers (the others are small pieces, for best-fit), and the class of each: every length by itself
    up to ``rows`` lengths; else those over a quarter of the capacity, in classes of about equal volume."""
    if len(lengths) <= rows:
        return np.arange(len(lengths)), np.arange(len(lengths))
    large = np.flatnonzero(lengths > capacity // 4)
    volume = np.cumsum(lengths[large] * count[large])
    return large, np.unique((volume - 1) * rows // volume[-1], return_inverse=True)[1] if len(large) else large


class _Runs:
    """The pieces of one class, longest first."""

    def __init__(self, index: np.ndarray, count: np.ndarray):
        self.runs = [[int(i), int(n)] for i, n in zip(index[::-1], count[::-1], strict=True)]

    def alike(self, times: int) -> int:
        """How many bins can have the same ``times`` pieces next; at least 1."""
        return max(1, self.runs[0][1] // times)

    def take(self, times: int, bins: int) -> list[tuple[int, int]]:
        out, more = [], times * bins
        while more:
            run = self.runs[0]
            n = min(more, run[1])
            out.append((run[0], n // bins))
            more, run[1] = more - n, run[1] - n
            if not run[1]:
                self.runs.pop(0)
        return out


def solve(histogram: dict[int, int], capacity: int = CAPACITY, work: int = 60_000, rows: int = 128) -> list[tuple[np.ndarray, int]]:
    """Configurations (lengths in them, how often): together they hold the histogram exactly.

    The program over the classes is solved, moved to a vertex, its amounts are rounded down and filled with pieces; what they leave is
    solved again, until rounding leaves nothing. The rest goes best-fit into what room the bins have, then to bins of its own.
    work: rounds times classes of one solution (48 to 1,000 rounds). rows: classes at most.
    """
    lengths = np.array(sorted(k for k, n in histogram.items() if n > 0), np.int64)
    left = np.array([histogram[int(k)] for k in lengths], np.int64)
    out: list[tuple[np.ndarray, int]] = []
    while (live := np.flatnonzero(left > 0)).size:
        of, cls = classes(lengths[live], left[live], capacity, rows)
        if not len(of):
            break
        of = live[of]
        heads = np.r_[np.flatnonzero(np.r_[True, cls[1:] != cls[:-1]]), len(of)]
        size, count = lengths[of[heads[1:] - 1]], np.add.reduceat(left[of], heads[:-1])
        # Room that is a sixteenth of a bin or more can be filled to the last token; it is left where small pieces are enough for that.
        volume, reserve = int((lengths[of] * left[of]).sum()), capacity // 16
        if (int((lengths * left).sum()) - volume) * (capacity - 2 * reserve) < 2 * reserve * volume:
            reserve = 0
        size = np.minimum(size, capacity - reserve)
        runs = [_Runs(of[a:b], left[of[a:b]]) for a, b in zip(heads, heads[1:], strict=False)]
        configs, _, _ = fractional(size, count, capacity - reserve, int(np.clip(work // len(size), 48, 1000)))
        rest, made = count.copy(), 0
        for k, t, v in sorted(vertex(configs, count, size, capacity - reserve), key=lambda c: -c[2]):
            use = min(int(v + 1e-6), int((rest[k] // t).min()))
            rest[k] -= t * use
            made += use
            while use > 0:
                bins = min(use, *(runs[c].alike(n) for c, n in zip(k.tolist(), t.tolist(), strict=True)))
                took = [x for c, n in zip(k.tolist(), t.tolist(), strict=True) for x in runs[c].take(n, bins)]
                for i, n in took:
                    left[i] -= n * bins
                out.append((np.repeat(lengths[[i for i, _ in took]], [n for _, n in took]), bins))
                use -= bins
        if not made:
            break
    return _best_fit(lengths, left, capacity, out)


def _sums(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Which numbers up to the capacity are sums of these lengths, each as often as wanted."""
    mask, bits = (1 << capacity + 1) - 1, 1
    for n in lengths.tolist():
        while n <= capacity:
            bits |= bits << n & mask
            n *= 2
    return np.unpackbits(np.frombuffer(bits.to_bytes(capacity // 8 + 1, "little"), np.uint8), bitorder="little")[: capacity + 1].astype(bool)


def _best_fit(lengths: np.ndarray, left: np.ndarray, capacity: int, begun: list[tuple[np.ndarray, int]]) -> list[tuple[np.ndarray, int]]:
    """The begun bins, fullest first, with what fits best into their room, then bins for the rest, each begun with the longest piece.

    The piece that fits best is the longest whose remaining room is a sum of lengths that are left. Equal bins are filled at once; where
    there are fewer pieces than bins, the other bins go on by themselves.
    """
    left, out = left.copy(), []
    todo = sorted(begun, key=lambda c: int(c[0].sum()))
    sums, kinds = _sums(lengths[left > 0], capacity), np.count_nonzero(left)

    def best(live: np.ndarray, room: int) -> np.ndarray:
        goal = room if sums[room] or kinds != np.count_nonzero(left) else int(np.flatnonzero(sums[: room + 1])[-1])
        fit = live[: np.searchsorted(lengths[live], goal, "right")]
        return fit[sums[goal - lengths[fit]]]

    while todo or left.any():
        config, use = todo.pop() if todo else (np.empty(0, np.int64), 0)
        room, add = capacity - int(config.sum()), []
        while True:
            live = np.flatnonzero(left[: np.searchsorted(lengths, room, "right")])
            if not len(live):
                break
            if use == 0:
                k, use = int(live[-1]), -(-int(left[live[-1]]) // 8)
            else:
                good = best(live, room)
                if not len(good) and (now := np.count_nonzero(left)) != kinds:
                    sums, kinds = _sums(lengths[left > 0], capacity), now
                    good = best(live, room)
                k = int(good[-1] if len(good) else live[-1])
            if left[k] < use:
                todo.append((np.concatenate([config, *add]), use - int(left[k])))
                use = int(left[k])
            left[k] -= use
            room -= int(lengths[k])
            add.append(lengths[k : k + 1])
        out.append((np.concatenate([config, *add]), use))
    return out


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> Plan:
    ranks: dict[int, int] = {}
    rows, seq = [], 0
    for config, n in solve(histogram, capacity):
        at = 0
        for length in map(int, config):
            rows.append((length, ranks.get(length, 0), seq, at))
            ranks[length] = ranks.get(length, 0) + n
            at += length
        seq += n
    a = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return Plan(a[:, 0], a[:, 1], a[:, 2], a[:, 3], seq)


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END, salt_rows: int = 20_000) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "packing")
    parts = scratch.save(pieces(docs, tokenizer, capacity, end), "pieces")
    rows = parts.groupBy("length").count().collect()  # at most capacity rows
    made = plan({r["length"]: r["count"] for r in rows}, capacity)
    total = sum(r["count"] for r in rows)
    salts = max(16, -(-total // salt_rows))
    salted = parts.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)).cast("int"))
    counts = salted.groupBy("length", "salt").count()
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("length", "salt", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("salt", "length").orderBy("doc_id", "piece", "ids_crc32")
    ranked = salted.withColumn("k", F.row_number().over(inside) - 1).join(base, ["salt", "length"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("k")).alias("rank"))
    sent = spark.sparkContext.broadcast((made.length, made.rank, made.seq, made.offset, made.sequences))  # a bounded number of rows

    def run(batches):
        made = Plan(*sent.value)
        for b in batches:
            seq, at = made.place(b.column(3).to_numpy(), b.column(5).to_numpy())
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(seq), pa.array(at)], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
