"""Packing texts of varying length into sequences of a fixed capacity.

Pattern packing: the histogram of lengths (bounded by the capacity, whatever the number of texts) is
fitted with repeat counts of length patterns by non-negative least squares, the counts are rounded, and what is
left of the histogram is fitted again until little is left, which best fit packs. Patterns aren't enumerated
beforehand, for a long capacity has too many good ones: a knapsack over the prices of the lengths that are
missed most gives, for each length, the best pattern that holds it (column generation).

All of this happens on the histogram. The texts then find their place by arithmetic: a text's rank among those of
its length step says which repeat of which pattern holds it. Ranks are distributed prefix sums over hash buckets, so a
length that a third of all texts have is no single task.

Lengths are told apart exactly while they are short and rounded up to one of ``BINS`` steps in equal ratios beyond; that
leaves up to one step of room to each long text, which isn't filled.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomline.llm.tokens import VOCABULARY, token_sizes
from loomline.plans.scratch import materialize

#: Steps of length that are told apart, short lengths exactly.
BINS = 800
#: A pattern that leaves a greater share of its sequence unused isn't fitted while others can be; then twice as much is allowed, up to the second value.
LOOSE, LOOSEST = 0.01, 0.16
#: What a sequence left empty costs, compared with a length that is missed.
WASTE = 0.02
#: Rounds of fitting and rounding, pricings in the first and in later ones, and units of capacity the knapsack tells apart.
ROUNDS, PRICINGS, AGAIN, UNITS = 100, 6, 2, 2048
#: Rows in a bucket of ranks, and the most buckets.
BUCKET_ROWS, MOST_BUCKETS = 20_000, 8192

Plan = list[tuple[tuple[int, ...], int]]


def edges_of(capacity: int, bins: int = BINS) -> list[int]:
    """Upper ends of the length steps: exact for short texts, then in equal ratios, and the capacity itself."""
    out, x = [], 1.0
    ratio = max(1.0005, float(capacity) ** (1 / bins))
    while x < capacity:
        if not out or int(x) > out[-1]:
            out.append(int(x))
        x = max(x + 1, x * ratio)
    return [*out, capacity] if not out or out[-1] != capacity else out


def knapsack(prices: np.ndarray, weights: np.ndarray, room: int) -> list[tuple[int, ...]]:
    """For each item that fits, the pattern of greatest price among those that hold it; items may repeat. Weights and room are whole units."""
    best, pick = np.zeros(room + 1), np.full(room + 1, -1)
    order = np.argsort(weights, kind="stable")
    w, p = weights[order], prices[order]
    fits = np.searchsorted(w, np.arange(room + 1), "right")
    for c in range(1, room + 1):
        best[c], pick[c] = best[c - 1], -1
        if n := fits[c]:
            value = best[c - w[:n]] + p[:n]
            k = int(value.argmax())
            if value[k] > best[c] + 1e-15:
                best[c], pick[c] = value[k], k
    out = []
    for k in range(int(fits[room])):
        pattern, c = [int(order[k])], room - int(w[k])
        while c > 0:
            if pick[c] < 0:
                c -= 1
                continue
            pattern.append(int(order[pick[c]]))
            c -= int(w[pick[c]])
        out.append(tuple(sorted(pattern, reverse=True)))
    return out


def _within(pattern: tuple[int, ...], left: np.ndarray, live: list[int], sizes: list[int], capacity: int, separator: int) -> tuple[int, ...]:
    """The pattern with no more of any step than there is; the room this leaves goes to the longest steps that fit."""
    counts: dict[int, int] = {}
    for i in pattern:
        counts[i] = counts.get(i, 0) + 1
    if all(left[i] >= c for i, c in counts.items()):
        return pattern
    counts = {i: min(c, int(left[i])) for i, c in counts.items()}
    room = capacity + separator - sum(c * (sizes[i] + separator) for i, c in counts.items())
    at = len(live)
    while (at := bisect_right(live, room - separator, 0, at, key=lambda i: sizes[i]) - 1) >= 0:
        i = live[at]
        if (c := min(int(left[i]) - counts.get(i, 0), room // (sizes[i] + separator))) > 0:
            counts[i] = counts.get(i, 0) + c
            room -= c * (sizes[i] + separator)
    return tuple(i for i in sorted(counts, reverse=True) for _ in range(counts[i]))


class _Columns:
    """Patterns in sparse form."""

    def __init__(self, weights: np.ndarray, capacity: int) -> None:
        self.weights, self.capacity = weights, capacity
        self.known: dict[tuple[int, ...], int] = {}
        self.rows, self.cols, self.vals = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, patterns: list[tuple[int, ...]]) -> int:
        new = [p for p in dict.fromkeys(patterns) if p not in self.known]
        rows, cols, vals = [], [], []
        for p in new:
            k = self.known[p] = len(self.known)
            for i in dict.fromkeys(p):
                rows.append(i)
                cols.append(k)
                vals.append(p.count(i))
        self.rows, self.cols, self.vals = np.append(self.rows, rows).astype(np.int64), np.append(self.cols, cols).astype(np.int64), np.append(self.vals, vals)
        return len(new)

    def waste(self) -> np.ndarray:
        return 1 - np.bincount(self.cols, weights=self.vals * self.weights[self.rows], minlength=len(self.known)) / self.capacity

    def held(self, x: np.ndarray) -> np.ndarray:
        return np.bincount(self.rows, weights=self.vals * x[self.cols], minlength=len(self.weights))

    def prices(self, per_step: np.ndarray) -> np.ndarray:
        return np.bincount(self.cols, weights=self.vals * per_step[self.rows], minlength=len(self.known))


def _least_squares(columns: _Columns, target: np.ndarray, cost: np.ndarray, x: np.ndarray, iterations: int = 120) -> np.ndarray:
    """Repeat counts that aren't negative, by projected gradients with momentum; ``cost`` is what a missed unit of each step costs."""
    waste = columns.waste()
    v = np.random.default_rng(0).random(len(columns.known))
    size = 1.0
    for _ in range(12):  # the largest eigenvalue sets the step
        v = columns.prices(cost * columns.held(v))
        size = np.linalg.norm(v) or 1.0
        v /= size
    step = 0.9 / size
    y, t = x.copy(), 1.0
    for _ in range(iterations):
        grad = columns.prices(cost * (columns.held(y) - target)) + WASTE * waste * target.mean()
        new = np.maximum(0, y - step * grad)
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y, x, t = new + (t - 1) / t2 * (new - x), new, t2
    return x


def fit(left: np.ndarray, sizes: list[int], capacity: int, separator: int, pricings: int = PRICINGS) -> tuple[list[tuple[int, ...]], np.ndarray, np.ndarray]:
    """``(patterns, repeats, waste)``: patterns that fit the histogram ``left``, found by pricing what the ones so far miss."""
    weights = np.array(sizes, np.int64) + separator
    whole = capacity + separator  # a separator after each text, with one more at the end
    unit = max(1, -(-whole // UNITS))
    live = np.nonzero(left)[0].tolist()
    scale = max(1.0, float(left.max()))
    target, cost = left / scale, weights / whole
    columns = _Columns(weights, whole)
    x = np.zeros(0)
    for _ in range(pricings):
        missed = cost * (target - columns.held(x)) if len(x) else cost * target
        # A full sequence is worth its share of the waste it spares.
        price = missed[live] + WASTE * target.mean() * weights[live] / whole
        found = knapsack(np.maximum(price, 1e-12), -(-weights[live] // unit), whole // unit)
        if not columns.add([_within(tuple(live[i] for i in p), left, live, sizes, capacity, separator) for p in found]):
            break
        x = _least_squares(columns, target, cost, np.append(x, np.zeros(len(columns.known) - len(x))))
    # Stopped early, the solution falls short of a long histogram everywhere; where only its proportions tell, it is scaled up.
    held = float(columns.held(x) @ weights)
    short = float(target @ weights) / held if held else 1.0
    return list(columns.known), x * scale * (1.0 if capacity < 4 * np.average(weights, weights=left) else max(1.0, min(8.0, short))), columns.waste()


def best_fit(left: np.ndarray, sizes: list[int], capacity: int, separator: int) -> Plan:
    """Pack what no fitted pattern took: the longest text first, then always the longest that fits, repeated as often as it can be."""
    left = left.astype(np.int64).copy()
    plan: Plan = []
    live = [i for i in range(len(sizes)) if left[i]]
    while live:
        pattern, room = [live[-1]], capacity - sizes[live[-1]]
        used = {live[-1]: 1}
        while True:
            at = bisect_right(live, room - separator, key=lambda i: sizes[i]) - 1
            while at >= 0 and left[live[at]] <= used.get(live[at], 0):
                at -= 1
            if at < 0:
                break
            i = live[at]
            # As many of one step as fit, for short texts come in great numbers.
            n = min(int(left[i]) - used.get(i, 0), (room // (sizes[i] + separator)) if sizes[i] + separator else int(left[i]))
            pattern += [i] * n
            used[i] = used.get(i, 0) + n
            room -= n * (sizes[i] + separator)
        n = min(int(left[i]) // k for i, k in used.items())
        for i, k in used.items():
            left[i] -= n * k
        plan.append((tuple(pattern), n))
        live = [i for i in live if left[i]]
    return plan


def fitted(histogram: np.ndarray, sizes: list[int], capacity: int, separator: int) -> tuple[Plan, np.ndarray]:
    """``(plan, left)``: rounded repeats of fitted patterns, and what they leave of the histogram."""
    left, plan, loose = histogram.astype(np.int64).copy(), [], LOOSE
    for turn in range(ROUNDS):
        if not left.any():
            break
        pats, x, waste = fit(left, sizes, capacity, separator, AGAIN if turn else PRICINGS)
        while loose <= LOOSEST and not (tight := [k for k in range(len(pats)) if x[k] > 0 and waste[k] <= loose]):
            loose *= 2
        if loose > LOOSEST:
            break
        # Whole repeats first; where there are none, one of each pattern that is wanted most.
        least = 1.0 if max(x[k] for k in tight) >= 1 else 0.3 * max(x[k] for k in tight)
        before = left.sum()
        for k in sorted((k for k in tight if x[k] >= least), key=lambda k: (-x[k], waste[k])):
            n = max(1, int(x[k]))
            counts = {i: pats[k].count(i) for i in dict.fromkeys(pats[k])}
            n = min([n, *(int(left[i]) // c for i, c in counts.items())])
            if n > 0:
                for i, c in counts.items():
                    left[i] -= n * c
                plan.append((pats[k], n))
        if left.sum() == before:
            loose *= 2
    return plan, left


def make_plan(histogram: np.ndarray, sizes: list[int], capacity: int, separator: int) -> Plan:
    """Patterns and repeats that hold the whole histogram. Size follows the number of steps, not of texts."""
    plan, left = fitted(histogram, sizes, capacity, separator)
    # Room in fitted patterns takes texts of the rest before new sequences are opened. A run is split only where a step runs out.
    grown: Plan = []
    for p, n in plan:
        pattern, todo = list(p), n
        room = capacity - sum(sizes[i] for i in pattern) - separator * (len(pattern) - 1)
        while todo:
            at = bisect_right(sizes, room - separator) - 1
            while at >= 0 and not left[at]:
                at -= 1
            if at < 0:
                grown.append((tuple(pattern), todo))
                break
            k = int(min(todo, left[at]))
            if k < todo:
                grown.append((tuple(pattern), todo - k))
            left[at] -= k
            pattern.append(at)
            room -= sizes[at] + separator
            todo = k
    return grown + best_fit(left, sizes, capacity, separator)


def pack(df: DataFrame, capacities: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """``profile, sequence_id, slot, doc_id, piece, token_start, n_tokens``: each text's place in each profile's sequences.

    ``capacities`` has few rows ``profile, capacity_tokens, separator_tokens``. A text longer than the
    capacity is cut into full sequences and one rest; no other text is split. Null texts and texts
    without tokens take no place. Between two neighbours of a sequence the separator is counted. Ids need not be
    unique: each row is placed. An empty table gives no rows.
    """
    sized = materialize(token_sizes(df, key, text, vocabulary=vocabulary).where("n_tokens > 0").withColumn("row", F.monotonically_increasing_id()), "packing-sizes")
    out = None
    for profile, capacity, separator in [(r["profile"], r["capacity_tokens"], r["separator_tokens"]) for r in capacities.select("profile", "capacity_tokens", "separator_tokens").orderBy("profile").collect()]:
        if not capacity or capacity < 1:
            raise ValueError(f"profile {profile}: the capacity must be positive")
        one = _pack_one(sized, capacity, separator or 0).select(F.lit(profile).alias("profile"), "sequence_id", "slot", F.col("id").alias(key), "piece", "token_start", "n_tokens")
        out = one if out is None else out.unionByName(one)
    if out is None:
        raise ValueError("no capacity is given")
    return out


def _pack_one(sized: DataFrame, capacity: int, separator: int) -> DataFrame:
    whole = (F.col("n_tokens") / capacity).cast("bigint")
    full = sized.where(F.col("n_tokens") >= capacity).select("id", "row", F.explode(F.sequence(F.lit(0).cast("bigint"), whole - 1)).alias("piece"))
    full = full.select("id", "row", "piece", (F.col("piece") * capacity).alias("token_start"), F.lit(capacity).cast("bigint").alias("n_tokens"))
    rest = sized.where(F.col("n_tokens") % capacity > 0).select("id", "row", whole.alias("piece"), (whole * capacity).alias("token_start"), (F.col("n_tokens") % capacity).alias("n_tokens"))
    edges = edges_of(capacity)
    ends = np.array(edges)
    step = F.pandas_udf(lambda n: pd.Series(np.searchsorted(ends, n.to_numpy(), "left"), dtype="int32"), "int")
    # More texts make more buckets, so that a window over one stays small; their number is bounded.
    buckets = int(min(MOST_BUCKETS, max(16, sized.count() // BUCKET_ROWS)))
    pieces = rest.unionByName(full).withColumn("step", step("n_tokens")).withColumn("bucket", F.pmod(F.xxhash64("row", "piece"), F.lit(buckets)))
    pieces = materialize(pieces, "packing-pieces")
    counts = pieces.groupBy("step", "bucket").agg(F.count("*").alias("n")).toArrow().to_pandas()  # steps x buckets, bounded
    histogram = np.zeros(len(edges), np.int64)
    np.add.at(histogram, counts["step"].to_numpy(np.int64), counts["n"].to_numpy(np.int64))
    plan = make_plan(histogram, edges, capacity, separator) if histogram.sum() else []

    # Of each step: how its ranks are dealt out, as runs (first rank, sequence of the run, per sequence, first slot).
    runs: dict[int, list[tuple[int, int, int, int]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for pattern, n in plan:
        slots: dict[int, int] = {}
        for i in pattern:
            slots[i] = slots.get(i, 0) + 1
        begin = 0
        for i in sorted(slots, reverse=True):
            runs.setdefault(i, []).append((used.get(i, 0), sequence, slots[i], begin))
            used[i] = used.get(i, 0) + slots[i] * n
            begin += slots[i]
        sequence += n
    per_bucket = np.zeros((len(edges), buckets), np.int64)
    np.add.at(per_bucket, (counts["step"].to_numpy(np.int64), counts["bucket"].to_numpy(np.int64)), counts["n"].to_numpy(np.int64))
    before = np.cumsum(per_bucket, axis=1) - per_bucket
    placed = pieces.withColumn("place", F.row_number().over(Window.partitionBy("step", "bucket").orderBy("row", "piece")) - 1)

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = {i: np.array(r, np.int64) for i, r in runs.items()}
        for pdf in batches:
            seq, slot = np.zeros(len(pdf), np.int64), np.zeros(len(pdf), np.int64)
            steps = pdf["step"].to_numpy(np.int64)
            ranks = before[steps, pdf["bucket"].to_numpy(np.int64)] + pdf["place"].to_numpy(np.int64)
            for i in np.unique(steps):
                at = np.nonzero(steps == i)[0]
                t = table[int(i)]
                k = np.searchsorted(t[:, 0], ranks[at], "right") - 1
                local = ranks[at] - t[k, 0]
                seq[at] = t[k, 1] + local // t[k, 2]
                slot[at] = t[k, 3] + local % t[k, 2]
            yield pd.DataFrame({"sequence_id": seq, "slot": slot.astype(np.int32), "id": pdf["id"], "piece": pdf["piece"], "token_start": pdf["token_start"], "n_tokens": pdf["n_tokens"]})

    kind = dict(sized.dtypes)["id"]
    return placed.select("id", "piece", "token_start", "n_tokens", "step", "bucket", "place").mapInPandas(deal, f"sequence_id bigint, slot int, id {kind}, piece bigint, token_start bigint, n_tokens bigint")


def packing_report(packed: DataFrame, capacities: DataFrame) -> DataFrame:
    """``profile, sequences, texts, tokens, capacity, utilisation, overfull`` of a packing; separators count as used."""
    per = packed.groupBy("profile", "sequence_id").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("texts"))
    joined = per.join(F.broadcast(capacities.select("profile", "capacity_tokens", "separator_tokens")), "profile")
    used = F.col("tokens") + (F.col("texts") - 1) * F.col("separator_tokens")
    return joined.groupBy("profile").agg(
        F.count("*").alias("sequences"), F.sum("texts").alias("texts"), F.sum("tokens").alias("tokens"), F.first("capacity_tokens").alias("capacity"),
        (F.sum(used) / F.sum("capacity_tokens")).alias("utilisation"), F.sum((used > F.col("capacity_tokens")).cast("int")).alias("overfull"),
    )


def packing_invariants(packed: DataFrame, capacities: DataFrame, df: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """``profile, n_texts, n_wrong_tokens, n_split_short, n_overfull`` of a packing of ``df`` with unique keys: texts placed, those whose pieces don't make up
    the text token by token, those split although they'd fit, and sequences beyond the capacity."""
    sizes = token_sizes(df, key, text, vocabulary=vocabulary).select(F.col("id").alias(key), F.col("n_tokens").alias("size"))
    limits = F.broadcast(capacities.select("profile", F.col("capacity_tokens").cast("bigint").alias("capacity"), "separator_tokens"))
    # Pieces that neither overlap nor leave a gap: their starts are the lengths before them.
    pieces = packed.groupBy("profile", key).agg(F.count("*").alias("n"), F.sum("n_tokens").alias("tokens"), F.sum("token_start").alias("starts"), F.max("piece").alias("last")).join(sizes, key).join(limits, "profile")
    right = (F.col("tokens") == F.col("size")) & (F.col("last") == F.col("n") - 1) & (F.col("starts") == F.col("capacity") * F.col("n") * (F.col("n") - 1) / 2)
    texts = pieces.groupBy("profile").agg(F.count("*").alias("n_texts"), F.count_if(~right).alias("n_wrong_tokens"), F.count_if((F.col("n") > 1) & (F.col("size") <= F.col("capacity"))).alias("n_split_short"))
    over = packing_report(packed, capacities).select("profile", F.col("overfull").alias("n_overfull"))
    return texts.join(over, "profile").select("profile", "n_texts", "n_wrong_tokens", "n_split_short", "n_overfull")


__all__ = ["pack", "packing_report", "packing_invariants", "make_plan", "fitted", "fit", "best_fit", "knapsack", "edges_of"]
