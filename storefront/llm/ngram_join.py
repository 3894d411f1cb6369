"""N-gram Jaccard join: documents whose sets of five-word shingles have Jaccard 0.8 or more.

Equal sets are one node of the search, named by a 64-bit hash of the whole set. Tokens
(64-bit hashes of shingles) are in one global order: rare ones first, then frequent ones,
each by hash. A token is frequent if over ``FREQUENT`` documents have it among their
lowest tokens. Two sets that share t tokens share k of them in their prefixes of size - t + k.

* Rare tokens of the prefix are indexed singly.
* Where a prefix takes in frequent tokens, it is extended to k = m + 1 and the frequent
  tokens are dealt by hash into m classes: a pair either shares a rare token, or two tokens
  of one class, so all two-token combinations within a class are indexed. m follows the
  size of the set by bands, and a set enters the bands in which its partners can lie.

Within an entry of the index every set is first compared with one member, its hub, chosen
by hash, so that a large group of near copies is a star, not all its pairs. Sets already in
one component need no more comparing. After ``HUB_ROUNDS`` rounds with other hubs the pairs
of unlike components are left. Entries with about as few of them, of sizes that fit, as
``FREQUENT`` sets can have compare all of theirs. The sets of other entries are indexed anew, in the order of how often tokens stand among them,
and compared with the hub of fewest own tokens first; then the index is made once more:

* A token that only one component holds cannot be shared by a pair that is left, so it comes
  first in the order, and a set with too few others can have no partner at all.
* The smaller set of a pair shares more of itself than the larger one must, so it is indexed
  by a shorter prefix. The number of its tokens that others hold bounds its partners' sizes,
  and those that its nearest large component holds bound them there; sets meet by size as
  well as by token.

No link is lost: both are bounds on pairs that have the similarity. Every comparison is
exact, on the whole sets, read again from the texts of those concerned.

Cases: NULL, empty and wordless texts have no shingle and link with nothing; texts of fewer
than five words are one shingle; rows repeated whole each get their row; a NULL doc_id never
names a component unless nothing else can (then NULL); other columns are left alone; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storefront.llm.common import SPACES, Scratch, land, maybe_in, row_key, ship
from storefront.llm.components import components
from storefront.llm.store import release

SHINGLE = 5
PERCENT = 80
FREQUENT = 32
SPARE = 1.25  # lowest tokens listed at first, as a multiple of the prefix (exact in binary)
SINGLES_BELOW = 10  # smaller sets index every prefix token singly
BAND = 1.5625  # sizes of a band, largest over smallest
HUB_ROUNDS = 2
SLOT = 1.05  # sizes that meet in one entry of the later index, largest over smallest
ROWS_AT_ONCE = 256
_MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """A fixed scrambling of 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(_MIX[0])
        x = (x ^ (x >> np.uint64(27))) * np.uint64(_MIX[1])
    return x ^ (x >> np.uint64(31))


# One number for each byte at each of the first places of a word; later places are set apart by a scrambling.
_PLACES = 64
_LETTERS = _mix(np.arange(1, _PLACES * 256 + 1, dtype=np.uint64) * np.uint64(_MIX[2]))
_INSIDE = bytes(chr(c) not in SPACES for c in range(256))  # by byte: is it of a word?
_TURNS = _mix(np.arange(1, SHINGLE + 1, dtype=np.uint64)) | np.uint64(1)


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of each word of a whole text, A-Z lower-cased."""
    lowered = b" %b " % text.encode().lower()
    inside = np.frombuffer(lowered.translate(_INSIDE), bool)
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    lengths = edges[1::2] - edges[::2]
    if not len(lengths):
        return np.zeros(0, np.uint64)
    first = np.cumsum(lengths) - lengths
    letters = np.frombuffer(lowered, np.uint8)[inside]
    place = np.arange(len(letters), dtype=np.int32) - np.repeat(first.astype(np.int32), lengths)
    value = _LETTERS.take(((place & (_PLACES - 1)) << 8) | letters)
    if lengths.max() > _PLACES:
        far = np.flatnonzero(place >= _PLACES)
        value[far] = _mix(value[far] + (place[far] // _PLACES).astype(np.uint64))
    return _mix(np.add.reduceat(value, first) + lengths.astype(np.uint64))


def shingle_set(text: str | None) -> np.ndarray:
    """The sorted distinct tokens of a whole text, as signed 64-bit numbers."""
    hashes = word_hashes(text) if isinstance(text, str) else np.zeros(0, np.uint64)
    if not len(hashes):
        return np.zeros(0, np.int64)
    size = min(SHINGLE, len(hashes))
    token = np.full(len(hashes) - size + 1, size, np.uint64)
    for j in range(size):
        token += hashes[j : len(hashes) - size + 1 + j] * _TURNS[j]
    token = np.sort(_mix(token).view(np.int64))
    return token[np.append(True, token[1:] != token[:-1])]


def shared_least(n: int) -> int:
    """Tokens that a set of ``n`` must share with any partner."""
    return -(-PERCENT * n // 100)


def prefix(n: int, k: int = 1) -> int:
    return min(n, n - shared_least(n) + k)


def band(n: int) -> int:
    return int(log(n) / log(BAND))


def classes(b: int) -> int:
    """Classes of frequent tokens in a band: half the prefix of its smallest set."""
    return max(1, prefix(ceil(BAND**b)) // 2)


def _bands(n: int) -> list[int]:
    """The bands in which a set meets its partners: its own, and the next if they reach it."""
    own = band(n)
    return [own, own + 1] if band(n * 100 // PERCENT) > own or band(n * 100 // PERCENT + 1) > own else [own]


def _pair_keys(b: int, tokens: np.ndarray, m: int) -> np.ndarray:
    """Keys of all two-token combinations within one of ``m`` classes."""
    of = (tokens.view(np.uint64) % np.uint64(m)).astype(np.int64)
    order = np.argsort(of, kind="stable")
    tokens, of = tokens[order].view(np.uint64), of[order]
    keys = []
    for apart in range(1, len(tokens)):
        same = np.flatnonzero(of[apart:] == of[:-apart])
        if not len(same):
            break
        low, high = np.minimum(tokens[same], tokens[same + apart]), np.maximum(tokens[same], tokens[same + apart])
        with np.errstate(over="ignore"):
            keys.append(_mix(_mix(low + np.uint64(b + 1)) * np.uint64(_MIX[2]) + high))
    return np.unique(np.concatenate(keys)).view(np.int64) if keys else np.zeros(0, np.int64)


def _slices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    release()
    for batch in batches:
        for at in range(0, len(batch), ROWS_AT_ONCE):
            yield batch.iloc[at : at + ROWS_AT_ONCE]


def sets(docs: DataFrame, text: str = "text", whole: bool = False) -> DataFrame:
    """(doc_id, key, node, n, tokens): the lowest tokens of each set, or the whole set.

    ``key`` tells rows of one doc_id with unlike texts apart.
    """

    def run(batches):
        for part in _slices(batches):
            found = [shingle_set(t) for t in part["text"]]
            # NULLs must not turn the hashes of a batch into floating-point numbers
            names = [int(np.uint64(xxhash.xxh3_64_intdigest(x.tobytes())).view(np.int64)) if len(x) else None for x in found]
            yield pd.DataFrame(
                {
                    "doc_id": part["doc_id"].to_numpy(),
                    "key": part["key"].to_numpy(),
                    "node": pd.array(names, dtype="Int64"),
                    "n": [len(x) for x in found],
                    "tokens": [x if whole else x[: listed(len(x))] for x in found],
                }
            ).astype({"doc_id": "Int64"})

    ship(docs.sparkSession)
    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key(text).alias("key"), F.col(text).alias("text"))
    return picked.mapInPandas(run, "doc_id long, key long, node long, n long, tokens array<long>")


def listed(n: int) -> int:
    """How many of the lowest tokens of a set of ``n`` are listed at first."""
    return min(n, int(SPARE * prefix(n)) + 4)


def _entries(rows: DataFrame) -> DataFrame:
    """Index entries (key, node, n) of whole sets that lack rare tokens among their lowest.

    ``rows``: node, n, tokens, frequent (those of the tokens that are).
    """

    def run(batches):
        for part in _slices(batches):
            nodes, sizes, keys = [], [], [np.zeros(0, np.int64)]
            for node, n, tokens, common in zip(part["node"], part["n"], part["tokens"], part["frequent"]):
                tokens, common = np.asarray(tokens, np.int64), np.sort(np.asarray(common, np.int64))
                rare = np.setdiff1d(tokens, common)
                found = []
                if n < SINGLES_BELOW:
                    taken = prefix(n)
                    found = [rare[:taken], common[: max(0, taken - len(rare))]]
                else:
                    for b in _bands(n):
                        taken = prefix(n, classes(b) + 1)
                        found += [rare[:taken], _pair_keys(b, common[: max(0, taken - len(rare))], classes(b))]
                own = np.unique(np.concatenate(found))
                nodes += [node] * len(own)
                sizes += [n] * len(own)
                keys.append(own)
            yield pd.DataFrame({"key": np.concatenate(keys), "node": np.array(nodes, np.int64), "n": np.array(sizes, np.int64)})

    return rows.mapInPandas(run, "key long, node long, n long")


def _whole_sets(docs: DataFrame, text: str, listing: DataFrame, nodes: DataFrame, label: str, held: Scratch) -> DataFrame:
    """(node, n, tokens) of the given nodes, each from one text, found by its own key."""
    land = held.land
    nodes = land(nodes, label)
    named = listing.where(maybe_in(nodes, F.col("node"))).join(nodes, "node", "left_semi")
    named = land(named.groupBy("node").agg(F.min("key").alias("_key")).select("_key"), label)
    texts = docs.select("doc_id", text, row_key(text).alias("_key"))
    picked = texts.where(maybe_in(named, F.col("_key"))).join(named, "_key", "left_semi")
    found = sets(picked, text, whole=True).join(nodes, "node", "left_semi")
    return land(found.groupBy("node").agg(F.any_value("n").alias("n"), F.any_value("tokens").alias("tokens")), label)


def _verified(pairs: DataFrame, whole: DataFrame) -> DataFrame:
    """The (a, b) of ``pairs`` whose sets have the similarity."""
    a = whole.select(F.col("node").alias("a"), F.col("n").alias("_na"), F.col("tokens").alias("_ta"))
    b = whole.select(F.col("node").alias("b"), F.col("n").alias("_nb"), F.col("tokens").alias("_tb"))
    met = pairs.join(a, "a").join(b, "b")
    both = F.size(F.array_intersect("_ta", "_tb"))
    return met.where(100 * both >= PERCENT * (F.col("_na") + F.col("_nb") - both)).select("a", "b")


def _fits(n: str, m: str) -> Column:
    """Sizes that can have the similarity."""
    return (100 * F.col(n) >= PERCENT * F.col(m)) & (100 * F.col(m) >= PERCENT * F.col(n))


def _lacking(marked: DataFrame) -> DataFrame:
    """Nodes without a prefix of rare tokens among their listed ones; ``marked``: their frequent ones."""
    counted = marked.groupBy("node").agg(F.any_value("n").alias("n"), F.count("*").alias("_f"))
    return counted.where(_listed("n") - F.col("_f") < _prefix("n")).select("node")


def index(docs: DataFrame, listing: DataFrame, text: str = "text", kept: Scratch | None = None) -> tuple[DataFrame, DataFrame]:
    """(key, node, n), where sets that have the similarity share a key, and (node, shared), the
    listed tokens of each set that other sets list too; both go with ``kept``, if that is given."""
    held, kept = Scratch(), kept or Scratch()
    tokens = listing.select("node", "n", F.explode("tokens").alias("token"))
    stats = tokens.groupBy("token").agg(F.count("*").alias("_c"), F.min("node").alias("_lo"), F.max("node").alias("_hi"))
    shared = held.land(stats.where("_lo <> _hi").select("token", (F.col("_c") > FREQUENT).alias("frequent")), "shared-tokens")
    near = tokens.where(maybe_in(shared.select("token"), F.col("token"), 1 << 24))
    hits = held.land(near.join(shared, "token").distinct(), "listed-tokens")

    # sets short of rare tokens are read whole; their tokens may be frequent among them only
    first = _whole_sets(docs, text, listing, _lacking(hits.where("frequent")), "lacking", held)
    counted = first.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("_c"))
    frequent = counted.where(F.col("_c") > FREQUENT).select("token").unionAll(shared.where("frequent").select("token"))
    frequent = held.land(frequent.distinct(), "frequent-tokens")
    # also listed tokens that no other set lists can be frequent among the whole sets
    marked = tokens.where(maybe_in(frequent, F.col("token"))).join(frequent, "token").distinct()
    more = _whole_sets(docs, text, listing, _lacking(marked).join(first, "node", "left_anti"), "lacking-more", held)
    whole = first.unionAll(more)

    exploded = whole.select("node", F.explode("tokens").alias("token"))
    common = exploded.join(frequent, "token").groupBy("node").agg(F.collect_list("token").alias("frequent"))
    empty = F.array().cast("array<long>")
    extended = held.land(_entries(whole.join(common, "node", "left").withColumn("frequent", F.coalesce("frequent", empty))), "extended")
    # tokens of extended prefixes that stand in one list only, or that small sets index singly though they are
    # frequent: in the lists of sets of a size that one of the extended sets can be a partner of
    sizes = extended.groupBy(F.col("key").alias("token")).agg(F.min("n").alias("_least"), F.max("n").alias("_most"))
    keys = held.land(sizes, "extended-keys")
    reached = (100 * F.col("n") >= PERCENT * F.col("_least")) & (100 * F.col("_most") >= PERCENT * F.col("n"))
    others = tokens.where(maybe_in(keys.select("token"), F.col("token"))).join(keys, "token").where(reached)
    others = others.select(F.col("token").alias("key"), "node", "n")
    singles = hits.join(frequent, "token", "left_anti").select(F.col("token").alias("key"), "node", "n")
    entries = held.land(singles.unionAll(others).unionAll(extended).distinct(), "entries")
    live = entries.groupBy("key").agg(F.count("*").alias("_c")).where("_c > 1").select("key")
    lists = hits.groupBy("node").agg(F.collect_list("token").alias("shared"))
    landed = kept.land(entries.join(live, "key", "left_semi"), "entries"), kept.land(lists, "listed-tokens")
    held.clear()
    return landed


def links(docs: DataFrame, listing: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(a, b) that connect all nodes with the similarity, and (node, component) of those they connect;
    see the module for which pairs."""
    kept = Scratch()
    entries, lists = index(docs, listing, text, kept)

    def tested(pairs, tried, turn, whole=None):
        held = Scratch()
        pairs = kept.land(_new_pairs(pairs, tried), f"pairs-{turn}")
        near = held.land(_near(pairs, lists), f"near-{turn}")
        if whole is None:
            whole = _whole_sets(docs, text, listing, near.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "sets", held)
        new = land(_verified(near, whole), f"links-{turn}")
        held.clear()
        return pairs.select("a", "b"), new

    def placed(rows, joined):
        placed = rows.drop("component").join(joined.withColumnRenamed("component", "_new"), "node", "left")
        return placed.withColumn("component", F.coalesce("_new", "node")).drop("_new")

    of, tried, found, joined = entries.withColumn("component", F.col("node")), None, None, None
    for turn in range(HUB_ROUNDS):
        pairs, new = tested(_hub_pairs(of, F.xxhash64("node", F.lit(turn))), tried, turn)
        if found is not None and pairs.isEmpty():
            break
        tried = pairs if tried is None else tried.unionAll(pairs)
        found, joined = _with(found, joined, new)
        of = placed(of.drop("members"), joined)
        split = of.groupBy("key").agg(
            F.min("component").alias("_lo"), F.max("component").alias("_hi"), F.count("*").alias("members")
        ).where("_lo <> _hi")
        of = kept.land(of.join(split.select("key", "members"), "key"), f"entries-{turn}")

    held = Scratch()
    heavy = held.land(_heavy(of), "heavy-keys")
    light = of.drop("members").join(heavy, "key", "left_anti")
    other = light.select("key", F.col("node").alias("_other"), F.col("n").alias("_m"), F.col("component").alias("_c"))
    pairs = light.join(other, "key").where("node < _other").where(_unlike()).drop("key")
    if heavy.isEmpty():
        _, new = tested(pairs, tried, HUB_ROUNDS)
        found, joined = _with(found, joined, new)
    else:
        crowd = held.land(of.join(heavy, "key", "left_semi").select("node", "component").distinct(), "crowd")
        whole = _whole_sets(docs, text, listing, crowd.select("node"), "crowd-sets", held).join(crowd, "node")
        # the hub of an entry is now the set with the fewest tokens of its own
        hubs = _hub_pairs(_crowd_index(whole, held, homes=False), F.struct(-F.col("common"), F.xxhash64("node")))
        pairs, new = tested(pairs.unionByName(hubs), tried, HUB_ROUNDS)
        found, joined = _with(found, joined, new)
        _, new = tested(_crowd_pairs(_crowd_index(placed(whole, joined), held, homes=True)), tried.unionAll(pairs), HUB_ROUNDS + 1, whole)
        found, joined = _with(found, joined, new)
    held.clear()
    kept.clear()
    return found, joined


def _heavy(of: DataFrame) -> DataFrame:
    """Keys of entries with more pairs of unlike components and fitting sizes than ``FREQUENT`` sets have.

    Such sizes stand in one step of a scale or in neighbouring ones; the pairs of one step are
    counted twice, so an entry that is left has at most twice as many.
    """
    step = F.floor(F.log("n") / log(100 / PERCENT))
    steps = of.where(F.col("members") > FREQUENT).select("key", "component", F.explode(F.array(step, step + 1)).alias("_step"))
    alike = steps.groupBy("key", "_step", "component").agg(F.count("*").alias("_c"))
    met = alike.groupBy("key", "_step").agg(F.sum("_c").alias("_c"), F.sum(F.col("_c") * F.col("_c")).alias("_alike"))
    pairs = F.sum(F.col("_c") * F.col("_c") - F.col("_alike")) / 2
    return met.groupBy("key").agg(pairs.alias("_pairs")).where(F.col("_pairs") > FREQUENT * (FREQUENT - 1)).select("key")


def _with(found: DataFrame | None, joined: DataFrame | None, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All links and their components, the new links taken in."""
    if found is None:
        return new, components(new)
    if new.isEmpty():
        return found, joined
    return found.unionAll(new), components(joined.select(F.col("node").alias("a"), F.col("component").alias("b")).unionAll(new))


def _hub_pairs(of: DataFrame, order: Column) -> DataFrame:
    """(node, n, component, _other, _m, _c): every set of an entry and the entry's first set by ``order``."""
    hubs = of.groupBy("key").agg(F.min_by(F.struct("node", "n", "component"), order).alias("_hub"))
    return of.join(hubs, "key").select(
        "node", "n", "component", F.col("_hub.node").alias("_other"), F.col("_hub.n").alias("_m"), F.col("_hub.component").alias("_c")
    ).where(_unlike())


def _unlike() -> Column:
    return (F.col("component") != F.col("_c")) & _fits("n", "_m")


def _crowd_index(whole: DataFrame, held: Scratch, homes: bool) -> DataFrame:
    """(key, smaller, node, n, component, most, common, home, most_home): the later index of sets (node, n, tokens, component).

    ``most`` is the largest size of a partner, ``common`` the share of tokens that other components hold,
    ``home`` the other component that holds most of them, ``most_home`` the largest size of a partner there.
    Without ``homes`` no set is given one, which a comparison with hubs does not need.
    """
    tokens = whole.select("node", "n", "component", F.explode("tokens").alias("token"))
    holders = held.land(tokens.groupBy("token", "component").agg(F.count("*").alias("count")), "crowd-holders")
    spread = holders.groupBy("token").agg(F.sum("count").alias("count"), F.count("*").alias("_c"), F.max_by("component", F.struct("count", "component")).alias("_top"))
    useful = tokens.join(spread.where("_c > 1").drop("_c"), "token")
    if homes:
        useful = held.land(useful, "crowd-tokens")
        nearest = useful.where("_top <> component").groupBy("node").agg(F.mode("_top").alias("home"))
        there = holders.select("token", F.col("component").alias("home"), F.lit(1).alias("_there"))
        useful = useful.join(nearest, "node", "left").join(there, ["token", "home"], "left")
    else:
        useful = useful.withColumns({"home": F.lit(None).cast("long"), "_there": F.lit(None).cast("int")})
    counted = useful.groupBy("node").agg(
        *[F.any_value(c).alias(c) for c in ("n", "component")], F.any_value(F.col("home").cast("string")).alias("home"),
        F.count("_there").alias("at_home"), F.collect_list("token").alias("tokens"), F.collect_list("count").alias("counts"),
    )
    return held.land(_crowd_entries(counted.where(100 * F.size("tokens") >= PERCENT * F.col("n"))), "crowd-entries")


def _crowd_pairs(entries: DataFrame) -> DataFrame:
    """(node, n, component, _other, _m, _c): the pairs that meet in the later index, of sizes that both can bear."""
    smaller = entries.where("smaller").select(
        "key", F.col("node").alias("_other"), F.col("n").alias("_m"), F.col("component").alias("_c"),
        F.col("most").alias("_most"), F.col("home").alias("_home"), F.col("most_home").alias("_most_home"),
    )
    sizes = "n >= _m AND if(home <=> _c, most_home, most) >= _m AND if(_home <=> component, _most_home, _most) >= n"
    met = entries.where("NOT smaller").join(smaller, "key").where(sizes).where(_unlike())
    return met.select("node", "n", "component", "_other", "_m", "_c")


def largest_partner(n: int, useful: int) -> int:
    """The largest size of a set that can have the similarity to one of ``n`` while sharing ``useful`` at most."""
    return min(n * 100 // PERCENT, useful * (100 + PERCENT) // PERCENT - n)


def _slot(n: int) -> int:
    return int(log(n) / log(SLOT))


def slot_classes(slot: int) -> int:
    """Classes of frequent tokens where the smaller set is of this slot; none: all are indexed singly."""
    least = ceil(SLOT**slot)
    return 0 if least < SINGLES_BELOW else max(1, prefix(least) // 2)


def crowd_keys(n: int, tokens: np.ndarray, counts: np.ndarray) -> Iterator[tuple[bool, np.ndarray]]:
    """The keys of a set as the smaller of a pair (True) and as the larger, from its useful tokens."""
    order = np.lexsort((tokens, counts))
    tokens, rare = tokens[order], counts[order] <= FREQUENT
    alone, most, least = n - len(tokens), largest_partner(n, len(tokens)), shared_least(n)
    # a set shares the more with a partner, the larger that is
    roles = [(True, -(-2 * PERCENT * n // (100 + PERCENT)), range(_slot(n), _slot(n) + (most >= n)))]
    if most >= least:
        roles.append((False, least, range(_slot(least), _slot(min(n, most)) + 1)))
    for smaller, shared, slots in roles:
        for slot in slots:
            m = slot_classes(slot)
            asked = max(shared, -(-PERCENT * (n + int(SLOT**slot) - 1) // (100 + PERCENT)))
            taken = max(0, n - asked + 1 - alone)
            if not rare[:taken].all():
                taken += m
            low, is_rare = tokens[:taken], rare[:taken]
            if m:
                low = np.concatenate([low[is_rare], _pair_keys(slot, low[~is_rare], m)])
            with np.errstate(over="ignore"):
                yield smaller, np.unique(_mix(low.view(np.uint64) + np.uint64(slot + 1)).view(np.int64))


def _crowd_entries(useful: DataFrame) -> DataFrame:
    """The rows of ``_crowd_index`` for sets given by their useful tokens and how many sets hold each."""

    def run(batches):
        for part in _slices(batches):
            made = []
            columns = ("node", "n", "component", "home", "at_home", "tokens", "counts")
            for node, n, component, home, at_home, tokens, counts in zip(*[part[c] for c in columns]):
                tokens, counts = np.asarray(tokens, np.int64), np.asarray(counts, np.int64)
                home = int(home) if home else component  # a set without a home never meets its own component
                most = largest_partner(n, len(tokens))
                of = (node, n, component, most, len(tokens) / n, home, largest_partner(n, at_home))
                made += [(keys, smaller, *of) for smaller, keys in crowd_keys(n, tokens, counts)]
            if made:
                keys, *others = zip(*made)
                times = [len(x) for x in keys]
                columns = {c: np.repeat(np.array(x), times) for c, x in zip(names[1:], others)}
                yield pd.DataFrame({"key": np.concatenate(keys), **columns})

    schema = "key long, smaller boolean, node long, n long, component long, most long, common double, home long, most_home long"
    names = [x.split()[0] for x in schema.split(", ")]
    return useful.mapInPandas(run, schema)


def _new_pairs(pairs: DataFrame, tried: DataFrame | None) -> DataFrame:
    """(a, b, na, nb): pairs of unlike components, of sizes that fit, that were not compared before."""
    pairs = pairs.where(_unlike())
    first = F.col("node") > F.col("_other")
    pairs = pairs.select(
        F.greatest("node", "_other").alias("a"), F.least("node", "_other").alias("b"),
        F.when(first, F.col("n")).otherwise(F.col("_m")).alias("na"), F.when(first, F.col("_m")).otherwise(F.col("n")).alias("nb"),
    ).distinct()
    if tried is not None:
        pairs = pairs.join(tried, ["a", "b"], "left_anti")
    return pairs


def _near(pairs: DataFrame, lists: DataFrame) -> DataFrame:
    """Pairs that share as many listed tokens as the similarity asks: sets listing ``k - 1`` tokens
    more than their prefix have ``k`` of the tokens they share in both lists."""
    a = lists.select(F.col("node").alias("a"), F.col("shared").alias("_sa"))
    b = lists.select(F.col("node").alias("b"), F.col("shared").alias("_sb"))
    spare = F.least(_listed("na") - _prefix("na"), _listed("nb") - _prefix("nb"))
    met = pairs.join(a, "a").join(b, "b")
    return met.where(F.size(F.array_intersect("_sa", "_sb")) > spare).select("a", "b")


def _prefix(n: str) -> Column:
    return F.col(n) - F.floor((PERCENT * F.col(n) + 99) / 100) + 1


def _listed(n: str) -> Column:
    return F.least(F.col(n), F.floor(SPARE * _prefix(n)) + 4)


def near_duplicates(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, key (see ``sets``), n_shingles, component_id, and n_links, the sets that
    were found similar to the row's (those that were compared: once two sets are in one
    component they need not be)."""
    listing = land(sets(docs, text), "shingle-lists")
    found, joined = links(docs, listing, text)
    # names of components: the least doc_id of all rows in them
    rows = listing.select("doc_id", "key", "node", F.col("n").alias("n_shingles")).join(joined, "node", "left")
    rows = rows.withColumn("_group", F.coalesce("component", "node"))
    names = rows.where("_group IS NOT NULL").groupBy("_group").agg(F.min("doc_id").alias("_name"))
    degree = found.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("n_links"))
    named = rows.join(names, "_group", "left").join(degree, "node", "left")
    return named.select(
        "doc_id", "key", "n_shingles", F.coalesce("_name", "doc_id").alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links")
    )


def apply_near_duplicates(docs: DataFrame) -> DataFrame:
    """One document of each group, the one with the least doc_id; all columns of ``docs``.

    Rows without a doc_id stay. Rows repeated whole stay together or go together.
    """
    gone = near_duplicates(docs).where("doc_id <> component_id").select(F.col("doc_id").alias("_gone"), F.col("key").alias("_text")).distinct()
    kept = docs.join(gone, (docs.doc_id == gone._gone) & (row_key() == gone._text), "left_anti")
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
