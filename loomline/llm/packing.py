"""Packing token sequences by a configuration linear program over the length histogram."""

from __future__ import annotations

import re
import zlib
from base64 import b64decode
from collections import Counter
from collections.abc import Mapping
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomline.llm.common import as_texts, map_batches, unused
from loomline.session import cut

CAPACITY = 1024
END = 2
#: Rounds of the multiplicative-weights method, and the step by which a price moves in one.
ROUNDS = 300
STEP = 0.002
CLIP = 10
#: Share of the best price by which a configuration may miss it and still be taken.
SLACK = 0.01
#: Shares of the program's solution that the rounding tries to keep.
SHARES = (1.0, 0.9, 0.5, 0.0)
#: Pieces for each group over which the pieces of a length are dealt to be numbered, and the fewest groups.
GROUP_ROWS = 1 << 20
GROUPS = 256

Config = tuple[int, ...]  # lengths that share a sequence, longest first

#: The pattern of the byte-level vocabularies and tiktoken's agree on these characters in every version.
PLAIN = re.compile(r"[\t\n\r\x20-\x7e\xa1-\xac\xae-˿‐-‧]*")
GPT_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: A run without spaces that the fast encoder would have to merge as one word.
LONG_RUN = 4096


@lru_cache(maxsize=2)
def _encoders(vocabulary: str, ranks: str):
    """The vocabulary's own encoder, the fast one, and the added tokens, which only the first knows."""
    import tiktoken
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(vocabulary)
    added = [x.content for x in exact.get_added_tokens_decoder().values()]
    with open(ranks, "rb") as lines:
        table = {b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding("same vocabulary", pat_str=GPT_PATTERN, mergeable_ranks=table, special_tokens={})
    return exact, fast, added


def token_ids(text: str, vocabulary: str, ranks: str) -> np.ndarray:
    """Ids of ``vocabulary`` as its own encoder gives them without adding special tokens, unsigned 32-bit numbers.

    ``ranks`` holds the same vocabulary for a faster encoder, which takes texts of plain characters; all others, and
    those that spell an added token of the vocabulary, go to the vocabulary's own.
    """
    exact, fast, added = _encoders(vocabulary, ranks)
    if PLAIN.fullmatch(text) and not any(x in text for x in added) and max(map(len, text.split()), default=0) < LONG_RUN:
        return fast.encode_to_numpy(text, disallowed_special=())
    return np.array(exact.encode(text, add_special_tokens=False).ids, np.uint32)


def pieces_of(ids: np.ndarray, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length): whole if it fits; else pieces of ``capacity`` ids after a first, maybe shorter one."""
    first = len(ids) % capacity or min(capacity, len(ids))
    starts = [0, *range(first, len(ids), capacity)]
    return [(a, b - a) for a, b in zip(starts, [*starts[1:], len(ids)], strict=True)]


def tokenised(docs: DataFrame, vocabulary: str, ranks: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces (doc_id, piece, start, length, ids_crc32) of each row of ``docs``."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for doc, text in zip(batch.column("doc_id").to_pylist(), as_texts(batch.column("text")), strict=True):
            ids = np.append(token_ids(text, vocabulary, ranks), np.uint32(END)).astype("<u4")
            out += [(doc, k, a, n, zlib.crc32(ids[a : a + n])) for k, (a, n) in enumerate(pieces_of(ids, capacity))]
        return pa.RecordBatch.from_arrays(
            [pa.array(x, pa.int32() if k == 1 else pa.int64()) for k, x in enumerate(zip(*out, strict=True))],
            ["doc_id", "piece", "start", "length", "ids_crc32"],
        )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_batches(rows, work, "doc_id long, piece int, start long, length long, ids_crc32 long")


def priced(prices: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The knapsack's dynamic program: by capacity, the greatest price and the index of an item in it (-1: none)."""
    value, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for c in range(1, capacity + 1):
        value[c], last[c] = value[c - 1], -2  # as with one less
        fit = int(np.searchsorted(lengths, c, side="right"))
        if fit:
            gains = value[c - lengths[:fit]] + prices[:fit]
            k = int(gains.argmax())
            if gains[k] >= value[c]:
                value[c], last[c] = gains[k], k
    return value, last


def held_by(room: int, last: np.ndarray, lengths: np.ndarray) -> Counter[int]:
    """The items, by index, of the best knapsack within ``room``."""
    found = Counter()
    while room > 0:
        if last[room] >= 0:
            found[int(last[room])] += 1
            room -= int(lengths[last[room]])
        else:
            room -= 1
    return found


def fractional(histogram: Mapping[int, int], capacity: int) -> Counter[Config]:
    """Sequences by configuration: a near-optimal solution of the linear program that covers each length's count.

    The program's prices are multiplicative weights, at first in proportion to the lengths: a length that a round
    covers above its share gets cheaper, one below gets dearer. Each round prices configurations by the knapsack
    program and takes for each length the best configuration that holds it, if that is within SLACK of the best of
    all, as often as the length asks for. The solution is the mean of the rounds after the first third.
    """
    lengths = np.array(sorted(histogram))
    counts = np.array([histogram[x] for x in lengths.tolist()], float)
    logs, covered, found = np.log(lengths / capacity), np.zeros(len(lengths)), Counter()
    for turn in range(ROUNDS):
        prices = np.exp(logs - logs.max())
        value, last = priced(prices, lengths, capacity)
        through = prices + value[capacity - lengths]
        added = np.zeros(len(lengths))
        for k in np.flatnonzero(through >= (1 - SLACK) * through.max()).tolist():
            held = held_by(capacity - int(lengths[k]), last, lengths)
            held[k] += 1
            times = float(counts[k] / held[k])
            added[list(held)] += times * np.array(list(held.values()))
            if turn >= ROUNDS // 3:
                found[tuple(sorted((int(lengths[j]) for j in held.elements()), reverse=True))] += times
        covered += added if turn >= ROUNDS // 3 else 0
        share = added / counts * float((counts * lengths).sum() / (added * lengths).sum())
        logs -= STEP * np.minimum(share - 1, CLIP)
    scale = float((counts * lengths).sum() / (covered * lengths).sum())
    return Counter({c: x * scale for c, x in found.items()})


def best_fit(histogram: Mapping[int, int], capacity: int) -> Counter[Config]:
    """Longest first, each into the fullest open sequence that takes it; equal sequences are handled together."""
    open_: dict[int, Counter[Config]] = {}  # by room left
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        moved: dict[int, Counter[Config]] = {}
        for room in sorted(x for x in open_ if x >= length):
            while left and open_[room]:
                config, n = open_[room].popitem()
                room_now, config_now, take = room, config, 0
                fits = min(room // length, -(-left // n)) if n <= left else 1
                take = min(n, left) if n > left else n
                fits = max(1, min(fits, left // take))
                if take < n:
                    open_[room][config] += n - take
                config_now, room_now = config + (length,) * fits, room - length * fits
                moved.setdefault(room_now, Counter())[config_now] += take
                left -= take * fits
            if not left:
                break
        each = capacity // length
        if left >= each:
            moved.setdefault(capacity - each * length, Counter())[(length,) * each] += left // each
        if left % each:
            moved.setdefault(capacity - (left % each) * length, Counter())[(length,) * (left % each)] += 1
        for room, configs in moved.items():
            open_.setdefault(room, Counter()).update(configs)
        open_ = {room: configs for room, configs in open_.items() if configs}
    total = Counter()
    for configs in open_.values():
        total.update(configs)
    return total


def fullest(left: Mapping[int, int], capacity: int) -> Config:
    """The longest of ``left`` with those that fill its sequence best, by sums that subsets reach; long ones before short."""
    lengths = sorted(left, reverse=True)
    room = capacity - lengths[0]
    reach, within, seen = 1, (1 << (room + 1)) - 1, []
    for length in lengths:
        n, times = min(left[length] - (length == lengths[0]), room // length), 1
        while n > 0 and not reach >> room & 1:
            times = min(times, n)
            seen.append((length, times, reach))
            reach |= (reach << (length * times)) & within
            n, times = n - times, 2 * times
    at, held = reach.bit_length() - 1, [lengths[0]]
    for length, times, before in reversed(seen):
        if not before >> at & 1:
            at -= length * times
            held += [length] * times
    return tuple(sorted(held, reverse=True))


def filled(histogram: Mapping[int, int], capacity: int) -> Counter[Config]:
    """One fullest configuration after the other, each as often as its lengths are left: one of them is used up each time."""
    left, total = dict(histogram), Counter()
    while left:
        config = fullest(left, capacity)
        held = Counter(config)
        times = min(left[x] // n for x, n in held.items())
        total[config] += times
        left = {x: n - held[x] * times for x, n in left.items() if n > held[x] * times}
    return total


def rounded(solution: Mapping[Config, float], histogram: Mapping[int, int], share: float) -> tuple[Counter[Config], dict[int, int]]:
    """Whole sequences of ``share`` of the program's solution, and the lengths that stay over."""
    left, chosen = Counter(histogram), Counter()
    for config, times in sorted(solution.items(), reverse=True):
        held = Counter(config)
        whole = min(int(share * times + 1e-9), *(left[x] // n for x, n in held.items()))
        if whole > 0:
            chosen[config] += whole
            left.subtract({x: n * whole for x, n in held.items()})
    return chosen, {x: n for x, n in left.items() if n}


def plan(histogram: Mapping[int, int], capacity: int = CAPACITY) -> Counter[Config]:
    """How many sequences have which configuration, so that every length of ``histogram`` is held by its count.

    The program's solution is rounded down, as a whole and by SHARES of it; what stays over is packed best fit, or
    with the fullest configurations. The rounding of the fewest sequences is the plan. A share of nothing leaves all
    to best fit, so that no plan needs more sequences than that.
    """
    wanted = {x: n for x, n in histogram.items() if n}
    if not wanted:
        return Counter()
    solution, best = fractional(wanted, capacity), None
    for share in SHARES:
        chosen, left = rounded(solution, wanted, share)
        for rest in (filled, best_fit):
            now = chosen + rest(left, capacity)
            if best is None or now.total() < best.total():
                best = now
    return best


class Slots:
    """Where the k-th piece of each length goes, as arrays: no larger than the plan, whatever the number of pieces."""

    def __init__(self, configs: Mapping[Config, int]):
        used, first, rows = Counter(), 0, []
        for config, times in sorted(configs.items(), key=lambda x: (-sum(x[0]), x[0])):
            offset = 0
            for length, each in sorted(Counter(config).items(), reverse=True):
                rows.append((length, used[length], each, first, offset))
                used[length] += each * times
                offset += each * length
            first += times
        self.rows = np.array(sorted(rows), np.int64).reshape(-1, 5)

    def place(self, lengths: np.ndarray, ordinals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """sequence_id and offset."""
        wide = np.int64(1) << 44  # ordinals lie below, so that (length, ordinal) is one sortable number
        at = np.searchsorted(self.rows[:, 0] * wide + self.rows[:, 1], lengths * wide + ordinals, side="right") - 1
        _, start, each, first, offset = self.rows[at].T
        return first + (ordinals - start) // each, offset + (ordinals - start) % each * lengths


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (with ``length`` from 1 to ``capacity``) with sequence_id and offset.

    A piece that fills a sequence has one of its own, a negative number, and is neither counted nor shuffled. Only the
    histogram of the others, of ``capacity`` rows at most, comes to the driver. Pieces of a length are numbered within
    groups that a hash deals out, as many as the pieces ask for, so that no length, however common, meets in one task.
    Repeated rows are packed as often as they come, whatever their order; an empty table gives an empty result.
    """
    names = pieces.columns
    length, row, group, number, start = (unused(names, x) for x in ("length", "row", "group", "number", "start"))
    pieces = cut(pieces.withColumn(row, F.monotonically_increasing_id()))
    shorter = pieces.where(F.col("length") < capacity)
    totals = {x["length"]: x["count"] for x in shorter.groupBy("length").count().collect()}
    slots = Slots(plan(totals, capacity))
    groups = max(GROUPS, -(-sum(totals.values()) // GROUP_ROWS))
    dealt = shorter.withColumn(group, F.pmod(F.xxhash64(F.col(row)), F.lit(groups)))
    # one row for each length and group
    before = Window.partitionBy("length").orderBy(group).rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("length", group).count().select(
        F.col("length").alias(length), group, F.coalesce(F.sum("count").over(before), F.lit(0)).alias(start)
    )
    order = Window.partitionBy("length", group).orderBy(row)
    numbered = dealt.withColumn(number, F.row_number().over(order)).withColumnRenamed("length", length)
    numbered = numbered.join(starts, [length, group]).withColumnRenamed(length, "length")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        lengths, before, numbers = (batch.column(x).to_numpy(zero_copy_only=False).astype(np.int64) for x in ("length", start, number))
        sequence, offset = slots.place(lengths, before + numbers - 1)
        return pa.RecordBatch.from_arrays(
            [*(batch.column(x) for x in names), pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"]
        )

    schema = ", ".join(f"`{name}` {kind}" for name, kind in pieces.dtypes[:-1]) + ", sequence_id long, offset long"
    placed = map_batches(numbered.select(*names, start, number), work, schema)
    alone = pieces.where(F.col("length") >= capacity).select(
        *names, (-1 - F.col(row)).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return placed.unionByName(alone)


def best_fit_packing(docs: DataFrame, vocabulary: str, ranks: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is a document of the end token alone; a text of any length is encoded whole and cut into as many
    pieces as it takes. Null ids and repeated rows are packed like others, ties of length in any order, and further
    columns of ``docs`` have no part, whatever their names.
    """
    return pack(tokenised(docs, vocabulary, ranks, capacity, id_col, text_col), capacity)
