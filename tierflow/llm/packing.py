"""Problem 1: items of varying length into containers of fixed capacity.

Method: a grouping genetic algorithm. A solution is a list of containers, not of
items. Crossover injects the best-filled containers of one parent into a copy of
the other, containers that hold one of the injected items are taken apart (so no
item is in twice), and the displaced items are put back by best fit. Mutation takes
the worst-filled containers and some others apart and fills them anew, each with
the single item or the pair that leaves least. Fitness is the number of
containers, then the mean of (fill / capacity) squared.

Islands: the items of each key are dealt by a hash into shares of bounded size. A
ring of islands evolves each share, every island with its own population; after
each epoch the best-filled containers of an island go to the next one of the ring,
where crossover injects them. Evolution goes on until the bound that no packing can
beat is reached, or until several epochs in a row bring no better packing; no number
of generations is set. Shares are spread over all tasks. After a round,
containers filled to ``elite`` settle; the items of the others are dealt into new
shares over all tasks and evolve again, until a round brings no fewer containers
(what the round before had then stays). So a hot key is many shares, and no task
holds more than one share at once. Items are divided only if longer than the
capacity: into parts as long as the capacity, each filling a container, and a last
part that is packed.

Defined results: an item of unknown length (NULL, not finite) or not above 0,
or of a key without a positive capacity, comes out once with container NULL and
part 0. Repeated rows of one item id are the caller's to remove: every row is an
item. Ties are broken by item id, so results are the same on every run.
"""

from __future__ import annotations

import random
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.common import SMALL_ROWS, cut, ms

#: Items of one share on average (one task holds one share at a time).
SHARE_ITEMS = 1000

Bin = tuple[int, list[int]]  # fill, indices of items
_fill = itemgetter(0)


def best_fit(order: list[int], sizes: list[int], capacity: int, bins: list[Bin]) -> list[Bin]:
    """Puts items in the given order each into the fullest container it fits in."""
    least = min([sizes[i] for i in order], default=0)  # containers with less room take none
    room = sorted([(capacity - fill, i) for i, (fill, _) in enumerate(bins) if capacity - fill >= least])
    for item in order:
        size = sizes[item]
        at = bisect_left(room, (size, -1))
        if at == len(room):
            bins.append((size, [item]))
            if capacity - size >= least:
                insort(room, (capacity - size, len(bins) - 1))
        else:
            free, i = room.pop(at)
            fill, held = bins[i]
            bins[i] = (fill + size, [*held, item])
            if free - size >= least:
                insort(room, (free - size, i))
    return bins


def fill_up(order: list[int], sizes: list[int], capacity: int, enough: int) -> list[Bin]:
    """Containers filled one by one: the next item of ``order``, then what fills it best.

    While the room would hold a third item, items are taken in turn; the last place
    goes to the single item or the pair that leaves least, found by binary search."""
    items = sorted(sorted(order), key=sizes.__getitem__)
    loose = [sizes[i] for i in items]  # sizes of what is left, items beside them
    used: set[int] = set()
    bins: list[Bin] = []
    for seed in order:
        if seed in used:
            continue
        used.add(seed)
        size = sizes[seed]
        at = bisect_left(loose, size)
        if items[at] != seed:
            at = bisect_left(items, seed, at, bisect_right(loose, size, at))
        del loose[at], items[at]
        held, room = [seed], capacity - size
        while loose and loose[0] <= room:
            top = bisect_right(loose, room) - 1
            best, take = room - loose[top], (top,)
            if best > enough and top and best < 1.5 * loose[top]:
                # for each larger one the largest that still fits beside it
                i, j = 0, top
                while i < j:
                    left = room - loose[i] - loose[j]
                    if left < 0:
                        j -= 1
                        continue
                    if left < best:
                        best, take = left, (j, i)
                        if left <= enough:
                            break
                    i += 1
                    if i < j and room - loose[i] - loose[j] >= 0:
                        # jump to the last that fits beside j
                        i = min(j - 1, bisect_right(loose, room - loose[j], i, j) - 1)
            for k in take:
                room -= loose.pop(k)
                item = items.pop(k)
                used.add(item)
                held.append(item)
        bins.append((capacity - room, held))
    return bins


def fitness(bins: list[Bin], capacity: int) -> float:
    return sum([fill * fill for fill, _ in bins]) / (len(bins) * capacity * capacity)


def crossover(giver: list[Bin], taker: list[Bin], sizes: list[int], capacity: int, take: int) -> list[Bin]:
    """The ``take`` best-filled containers of the giver, injected into the taker."""
    injected = giver[:take]
    both = set(map(id, injected)).intersection(map(id, taker))  # containers that the parents share
    others = [one for one in taker if id(one) not in both]
    inside = {item for one in injected if id(one) not in both for item in one[1]}
    kept, displaced = list(injected), []
    for one in others:
        if inside.isdisjoint(one[1]):
            kept.append(one)
        else:
            displaced += [item for item in one[1] if item not in inside]
    displaced.sort(key=sizes.__getitem__, reverse=True)
    return best_fit(displaced, sizes, capacity, kept)


def mutate(bins: list[Bin], sizes: list[int], capacity: int, rng: random.Random, share: float) -> list[Bin]:
    """The worst-filled containers and as many others are taken apart, and their items filled in anew.

    ``bins`` by falling fill; containers that are full to a thousandth are left alone."""
    enough = capacity // 1000
    open_ = [k for k, (fill, _) in enumerate(bins) if capacity - fill > enough]
    n = max(2, int(len(bins) * share))
    apart = set(open_[-n:])
    apart.update(rng.sample(range(len(bins)), min(n, len(bins))))
    items = [i for k in apart for i in bins[k][1]]
    items.sort(key=lambda i: -sizes[i] * (0.8 + 0.2 * rng.random()))
    return [b for k, b in enumerate(bins) if k not in apart] + fill_up(items, sizes, capacity, enough // 4)


class Island:
    """A population of packings of the same items; the best comes first."""

    def __init__(self, sizes: list[int], capacity: int, rng: random.Random, population: int) -> None:
        self.sizes, self.capacity, self.rng, self.population = sizes, capacity, rng, population
        self.least = -(-sum(sizes) // capacity)
        order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
        self.people: list[tuple[float, list[Bin]]] = []
        self.add(best_fit(order, sizes, capacity, []))
        for _ in range(population - 1):
            if not self.done:
                shaken = sorted(order, key=lambda i: -sizes[i] * (0.8 + 0.2 * rng.random()))
                self.add(fill_up(shaken, sizes, capacity, capacity // 4000))

    @property
    def best(self) -> list[Bin]:
        return self.people[0][1]

    @property
    def standing(self) -> tuple[int, float]:
        """Containers and fitness of the best packing; lower is better."""
        fit, bins = self.people[0]
        return len(bins), -fit

    @property
    def done(self) -> bool:
        return len(self.best) <= self.least

    def add(self, bins: list[Bin]) -> None:
        """A new packing; beyond the population the worst goes."""
        bins.sort(key=_fill, reverse=True)
        self.people.append((fitness(bins, self.capacity), bins))
        self.people.sort(key=lambda p: (len(p[1]), -p[0]))
        del self.people[self.population :]

    def generation(self) -> None:
        """Crossover of two packings, then mutation of the child."""
        rng, people = self.rng, self.people
        i, j = (0, 0) if len(people) < 2 else sorted(rng.sample(range(len(people)), 2))
        taker, giver = people[i][1], people[j][1]
        child = crossover(giver, taker, self.sizes, self.capacity, max(1, len(giver) // 4))
        child.sort(key=_fill, reverse=True)
        self.add(mutate(child, self.sizes, self.capacity, rng, rng.uniform(0.02, 0.1)))

    def receive(self, elite: list[Bin]) -> None:
        """Well-filled containers of another island are injected into the best packing."""
        self.add(crossover(elite, self.best, self.sizes, self.capacity, len(elite)))


def evolve(sizes: list[int], capacity: int, seed: str, islands: int = 2, population: int = 4, generations: int = 10, patience: int = 4) -> list[Bin]:
    """The best packing that the islands find, containers by falling fill.

    Islands evolve apart; after each epoch of ``generations`` the best fifth of each one's
    containers goes to the next island of the ring. There is no set number of epochs: evolution
    ends at the bound none can beat, or once ``patience`` epochs in a row bring nothing better."""
    ring = [Island(sizes, capacity, random.Random(f"{seed}/{k}"), population) for k in range(islands)]
    best, idle = min(i.standing for i in ring), 0
    while idle < patience and not any(i.done for i in ring):
        for island in ring:
            for _ in range(generations):
                if any(i.done for i in ring):
                    break
                island.generation()
        if any(i.done for i in ring):
            break
        elites = [i.best[: max(1, len(i.best) // 5)] for i in ring]
        for k, elite in enumerate(elites):
            if len(ring) > 1:
                ring[(k + 1) % len(ring)].receive(elite)
        now = min(i.standing for i in ring)
        best, idle = (now, 0) if now < best else (best, idle + 1)
    return min(ring, key=lambda i: i.standing).best


def with_parts(items: DataFrame, item: str, key: str, length_ms: str, capacity_ms: str) -> DataFrame:
    """One row per part: part, parts, start_ms, end_ms; see the module's text."""
    n = F.when(
        (F.col(length_ms) > 0) & (F.col(capacity_ms) > 0),
        F.ceil(F.col(length_ms) / F.col(capacity_ms)),
    ).otherwise(F.lit(1)).cast("int")
    known = (F.col(length_ms) > 0) & (F.col(capacity_ms) > 0)
    return (
        items.withColumn("parts", n)
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .withColumn("start_ms", F.when(known, F.col("part") * F.col(capacity_ms)).cast("bigint"))
        .withColumn("end_ms", F.when(known, F.least(F.col(length_ms), (F.col("part") + 1) * F.col(capacity_ms))).cast("bigint"))
        .select(item, key, "part", "parts", "start_ms", "end_ms", F.col(capacity_ms).alias("capacity_ms"))
    )


def _round(df: DataFrame, item: str, key: str, elite: float, seed: str, effort: dict) -> DataFrame:
    """Evolves every share. settled: the container is full enough to stay; first: one row of each container."""
    # a number of its own, as adaptive execution would join partitions by their few bytes, however long they evolve
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.repartition(tasks, key, "share").sortWithinPartitions(key, "share", item, "part")
    names = [item, key, "part", "parts", "start_ms", "end_ms", "capacity_ms", "share"]

    def solve(table: pa.Table) -> dict[str, list]:
        name, place, capacity = (table.column(i)[0].as_py() for i in (1, 7, 6))
        sizes = (table.column(5).to_numpy() - table.column(4).to_numpy()).tolist()
        container, settled, first = [""] * len(sizes), [False] * len(sizes), [False] * len(sizes)
        for k, (fill, held) in enumerate(evolve(sizes, capacity, f"{seed}/{name}/{place}", **effort)):
            first[held[0]] = True
            for i in held:
                container[i] = f"{name}/{seed}/{place}/{k}"
                settled[i] = fill >= elite * capacity
        return {"container": container, "settled": settled, "first": first}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []

        def shares(final: bool) -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(waiting).combine_chunks()
            keys = table.column(1).combine_chunks().dictionary_encode().indices.to_numpy()
            places = table.column(7).to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(keys) | np.diff(places)) + 1).tolist(), len(keys)]
            if not final:
                edges.pop()  # the last share may go on in the next batch
            for a, b in zip(edges, edges[1:]):
                part = table.slice(a, b - a)
                for column, values in solve(part).items():
                    part = part.append_column(column, pa.array(values))
                yield from part.combine_chunks().to_batches()
            waiting[:] = table.slice(edges[-1]).to_batches() if not final else []

        for batch in batches:
            if batch.num_rows:
                waiting.append(batch)
                yield from shares(False)
        if waiting:
            yield from shares(True)

    schema = rows.select(*names).schema.add("container", "string").add("settled", "boolean").add("first", "boolean")
    return rows.select(*names).mapInArrow(run, schema)


def pack(
    items: DataFrame,
    limits: DataFrame,
    item: str = "instance_id",
    key: str = "dataset",
    length_ms: str = "length_ms",
    capacity_ms: str = "capacity_ms",
    elite: float = 0.998,
    share_items: int = SHARE_ITEMS,
    islands: int = 2,
    population: int = 4,
    generations: int = 10,
    patience: int = 4,
    seed: str = "pack",
) -> DataFrame:
    """container, ``item``, ``key``, part, parts, start_ms, end_ms of every part.

    ``items`` needs item, key, length_ms and is read once; ``limits`` has one row per
    key with capacity_ms. Each round is one shuffle by (key, share) of what has not
    settled yet. See the module's text for the method and edge cases."""
    limits = limits.select(key, capacity_ms)
    keys = limits.count()
    if keys > SMALL_ROWS:
        raise ValueError(f"{keys} keys have limits; at most {SMALL_ROWS} can")
    joined = items.select(item, key, length_ms).join(F.broadcast(limits), key, "left")
    parts = cut(with_parts(joined, item, key, length_ms, capacity_ms))
    out = [item, key, "part", "parts", "start_ms", "end_ms"]
    to_pack = (F.col("end_ms") - F.col("start_ms") > 0) & (F.col("end_ms") - F.col("start_ms") < F.col("capacity_ms"))
    full = F.when(F.col("end_ms").isNotNull(), F.concat_ws("/", key, F.lit("full"), item, F.col("part").cast("string")))
    done = parts.where(~F.coalesce(to_pack, F.lit(False))).select(full.alias("container"), *out)
    moving = parts.where(to_pack)
    effort = {"islands": islands, "population": population, "generations": generations, "patience": patience}
    k = settled = 0
    best: tuple[int, DataFrame] | None = None  # containers, and the rows of those that haven't settled
    while True:
        k += 1
        shares = F.greatest(F.ceil(F.count(F.lit(1)) / F.lit(share_items)), F.lit(1)).alias("shares")
        count = F.broadcast(moving.groupBy(key).agg(shares))  # at most one row per limit
        draw = F.xxhash64(F.lit(f"{seed}-{k}"), item, "part")
        dealt = moving.join(count, key).withColumn("share", F.pmod(draw, F.col("shares")))
        evolved = cut(_round(dealt, item, key, elite, f"{seed}-{k}", effort))
        found = {r.settled: r.n for r in evolved.where("first").groupBy("settled").agg(F.count(F.lit(1)).alias("n")).collect()}
        containers = settled + sum(found.values())
        if best and containers >= best[0]:
            break  # the open containers of the round before stay as they are
        settled += found.get(True, 0)
        done = done.unionByName(evolved.where("settled").select("container", *out))
        best = containers, evolved.where("not settled").select("container", *out)
        if not found.get(False):
            break
        moving = evolved.where("not settled").drop("container", "settled", "first", "share", "shares")
    return done.unionByName(best[1])


def divided(packed: DataFrame, item: str = "instance_id") -> DataFrame:
    """The items whose parts lie in more than one container."""
    per = packed.where("parts > 1").groupBy(item).agg(F.min("container").alias("_a"), F.max("container").alias("_b"))
    return per.where("_a <> _b").select(item)


def fill_report(packed: DataFrame, limits: DataFrame, key: str = "dataset", capacity_ms: str = "capacity_ms") -> DataFrame:
    """Per key: containers, used_ms, free_permille, and least_containers (a bound no packing can beat)."""
    used = packed.where("container is not null").withColumn("used", F.col("end_ms") - F.col("start_ms"))
    sums = used.groupBy(key).agg(F.count_distinct("container").alias("containers"), F.sum("used").alias("used_ms"))
    room = F.col("containers") * F.col(capacity_ms)
    return sums.join(limits.select(key, capacity_ms), key).select(
        key, "containers", "used_ms",
        ((room - F.col("used_ms")) * 1000 / room).alias("free_permille"),
        F.ceil(F.col("used_ms") / F.col(capacity_ms)).cast("bigint").alias("least_containers"),
    )


def utterance_lengths(current_utterances: DataFrame) -> DataFrame:
    """instance_id, dataset, length_ms: audio_length or, if NULL, end_t minus start_t."""
    length = F.coalesce(F.col("metadata.audio_length"), F.col("end_t") - F.col("start_t"))
    return current_utterances.select("instance_id", "dataset", ms(length).alias("length_ms"))
