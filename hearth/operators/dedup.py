"""Exact, grid and fuzzy duplicate removal, and conflict rules between a load and the serving table.

Every survivor rule ends in the listing's key, so results do not depend on row order.  Fuzzy duplicates are found by a
set-similarity join over address words inside a block, between profiles of like listings; groups are never collected.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearth.functions import geo
from hearth.functions.parse import key_text
from hearth.sources import tables

# Weights of the similarity, and the steps of relative difference with their share of a weight.
WEIGHTS = {"address": 0.3, "price": 0.25, "area": 0.2, "rooms": 0.15, "distance": 0.1}
STEPS = ((0.05, 1.0), (0.1, 0.8), (0.2, 0.5))
DISTANCES = ((100.0, 1.0), (500.0, 0.8), (1000.0, 0.5))
THRESHOLD = 0.85


def best_of(rows: DataFrame, keys: list[str | Column], *order: Column) -> DataFrame:
    """One row of each key: the first by the order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_place", F.row_number().over(w)).where(F.col("_place") == 1).drop("_place")


def newest(rows: DataFrame, date: str = "data_date", key: str = "id", tie: str = "listing_key") -> DataFrame:
    """The row of the latest data date of each id, rows without a date last, the least ``tie`` among equal ones."""
    return best_of(rows, [key], F.desc_nulls_last(date), F.asc(tie))


def rounded(c: Column) -> Column:
    """Half up, as an integer: keys are never built from printed fractions."""
    return F.floor(c + 0.5).cast("long")


def price_bucket(price: Column, tolerance: float) -> Column:
    """Bounds in tenths of a billion."""
    low, high = rounded(price * (1 - tolerance) / 1e8), rounded(price * (1 + tolerance) / 1e8)
    return F.when(price > 0, F.concat_ws("-", low, high)).otherwise("unknown")


def area_bucket(area: Column, tolerance: float = 10.0) -> Column:
    low, high = F.floor(F.greatest(area - tolerance, F.lit(0.0))), F.floor(area + tolerance)
    return F.when(area > 0, F.concat_ws("-", low, high)).otherwise("unknown")


def exact_key() -> Column:
    place = key_text(F.concat_ws("_", *[F.coalesce(F.col(c), F.lit("")) for c in ("province", "district", "ward", "street")]))
    rooms = [F.coalesce(F.col(c), F.lit(0)).cast("int").cast("string") for c in ("bedroom", "bathroom")]
    return F.md5(F.concat_ws("_", place, price_bucket(F.col("price"), 0.05), area_bucket(F.col("area")), *rooms))


def loose_key() -> Column:
    place = key_text(F.concat_ws("_", *[F.coalesce(F.col(c), F.lit("")) for c in ("province", "district")]))
    return F.concat_ws("_", place, price_bucket(F.col("price"), 0.2))


def stepped(difference: Column, steps) -> Column:
    chain = F.lit(0.0)
    for bound, share in reversed(steps):
        chain = F.when(difference <= bound, share).otherwise(chain)
    return F.coalesce(chain, F.lit(0.0))


def address(side: str = "") -> Column:
    """The places of a listing as one text; ``side`` is a column prefix with its dot."""
    return F.lower(F.trim(F.concat_ws(" ", *[F.nullif(F.col(side + c), F.lit("")) for c in ("street", "ward", "district", "province")])))


def words(text: Column) -> Column:
    return F.array_distinct(F.split(text, " +"))


def likeness_of_values(a: str, b: str) -> list[Column]:
    """The weighted parts of price, area and rooms."""
    col = lambda side, c: F.col(f"{side}.{c}")
    relative = lambda c: F.abs(col(a, c) - col(b, c)) / F.greatest(col(a, c), col(b, c))
    both = lambda c: (col(a, c) > 0) & (col(b, c) > 0)
    return [
        F.when(both("price"), stepped(relative("price"), STEPS)).otherwise(0.0) * WEIGHTS["price"],
        F.when(both("area"), stepped(relative("area"), STEPS)).otherwise(0.0) * WEIGHTS["area"],
        F.when(col(a, "bedroom") == col(b, "bedroom"), WEIGHTS["rooms"]).otherwise(0.0),
    ]


def likeness_of_spots(a: str, b: str) -> Column:
    """The weighted part of the distance."""
    col = lambda side, c: F.col(f"{side}.{c}")
    metres = geo.haversine(col(a, "latitude"), col(a, "longitude"), col(b, "latitude"), col(b, "longitude"))
    return stepped(metres, DISTANCES) * WEIGHTS["distance"]


def placeless(a: str, b: str, prepared: bool = False) -> Column:
    """Weighted likeness of two listings but for their distance, by the column prefixes ``a`` and ``b``; prepared ones have ``address`` and ``tokens``."""
    texts = [F.col(f"{s}.address") if prepared else address(s + ".") for s in (a, b)]
    sets = [F.col(f"{s}.tokens") if prepared else words(t) for s, t in zip((a, b), texts, strict=True)]
    overlap = F.size(F.array_intersect(*sets)) / F.size(F.array_union(*sets))
    place = F.when((texts[0] == "") | (texts[1] == ""), 0.0).when(texts[0] == texts[1], 1.0).when(F.contains(*texts) | F.contains(*texts[::-1]), 0.8).otherwise(overlap)
    return reduce(Column.__add__, likeness_of_values(a, b), place * WEIGHTS["address"])


def similarity(a: str, b: str) -> Column:
    """Weighted likeness of two listings with the column prefixes ``a`` and ``b``."""
    return placeless(a, b) + likeness_of_spots(a, b)


def graded(a: str, b: str) -> Column:
    """Likeness by falling lines in place of steps: same place, price to half, area to a fifth, both rooms, distance to 1 km."""
    col = lambda side, c: F.col(f"{side}.{c}")
    every = lambda names: reduce(Column.__and__, [col(a, c).eqNullSafe(col(b, c)) for c in names]).cast("double")
    relative = lambda c: F.abs(col(a, c) - col(b, c)) / F.greatest(col(a, c), col(b, c))
    both = lambda c: F.coalesce((col(a, c) != 0) & (col(b, c) != 0), F.lit(False))
    falling = lambda c, slope: F.when(both(c), F.greatest(F.lit(0.0), 1 - relative(c) * slope)).otherwise(0.0)
    metres = geo.haversine(col(a, "latitude"), col(a, "longitude"), col(b, "latitude"), col(b, "longitude"))
    near = F.when(both("latitude") & both("longitude"), F.when(metres < 50, 1.0).otherwise(F.greatest(F.lit(0.0), 1 - metres / 1000))).otherwise(0.0)
    return (
        every(("province", "district", "ward", "street")) * WEIGHTS["address"] + falling("price", 2.0) * WEIGHTS["price"] + falling("area", 5.0) * WEIGHTS["area"]
        + every(("bedroom", "bathroom")) * WEIGHTS["rooms"] + near * WEIGHTS["distance"]
    )


def plain_key(location: Column) -> Column:
    """Location without signs, price to a tenth of a billion, area to a unit, rooms and places; numbers as integers."""
    cleaned = F.lower(F.trim(F.regexp_replace(location, r"(?U)[^\w\s]", "")))
    numbers = [F.coalesce(rounded(F.col("price") / 1e8) * 100000000, F.lit(0)), F.coalesce(rounded(F.col("area")), F.lit(0)), F.coalesce("bedroom", F.lit(0)), F.coalesce("bathroom", F.lit(0))]
    places = [F.coalesce(F.col(c), F.lit("")) for c in ("province", "district", "ward")]
    return F.md5(F.concat_ws("|", F.coalesce(cleaned, F.lit("")), *[n.cast("string") for n in numbers], *places))


# How a listing is filed: under each of its first words, or once for all of them or for its whole block.
PREFIX, WHOLE = range(2)
EASE = 1e-6  # room for rounding in bounds


def _numbers(block: Column, listed: Column) -> Column:
    """Numbers for words, in an order that depends on the block and the word only: words of the place, which a block shares, come last."""

    def number(w: Column) -> Column:
        half = F.shiftrightunsigned(F.xxhash64(w), 1)
        return F.when(F.instr(block, F.translate(w, "-_", "")) > 0, half).otherwise(-half - 1)

    return F.transform(listed, number)


def candidates(rows: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Pairs of a block, as ``x`` and ``y`` columns, whose addresses and areas can reach the threshold; each pair once, in either order.

    Numbers give at most 0.7, so addresses must be alike by the rest of the threshold over their weight at least; where the
    rooms differ by 0.15 more.  Either case is a set-similarity join over the words of the addresses:

    - Word sets of ``m`` and ``n`` words of likeness ``l`` share ``least`` = l / (1 + l) * (m + n) words, so in any fixed order of the words a
      pair shares one of its first ``m - least + 1`` and ``n - least + 1`` words.  A listing is filed under each of its first words, and a pair
      is taken at the first one it shares: the position bound is part of that, as both words must be early enough.
    - An address that contains another counts 0.8 whatever their words; which addresses of a place do is found among its different
      addresses, however many listings have them (``contained``).
    - Where nothing less than the same words will do, listings are filed under all of their words at once.

    Rows are filed under a hash of block, rooms and word, so a frequent block is dealt over as many tasks as it has words.
    """
    need = ["listing_key", "price", "area", "bedroom"]
    parts = filed_pairs(rows.select(*need, loose_key().alias("block"), address().alias("address")).where("address <> ''"), need, threshold)
    ends = [F.struct(*[f"{side}.{c}" for c in (*need, "block", "address")]).alias(side) for side in ("x", "y")]
    return reduce(DataFrame.unionByName, [p.select(*ends) for p in parts])


def contained(addresses: DataFrame) -> DataFrame:
    """Pairs ``small, large`` of different addresses of a ``place``, the first of which stands inside the second.

    The words inside the small one are words of the large one, so it is found under one of them.  Addresses of one or two words, which
    have none, meet their whole place.
    """
    split = F.split("address", " +")
    common = lambda w: F.instr(F.col("place"), F.translate(w, "-_", "")) > 0
    inner = F.array_min(F.transform(F.slice(split, 2, F.greatest(F.size(split) - 2, F.lit(0))), lambda w: F.struct(common(w), F.xxhash64(w), w.alias("w"))))
    one = addresses.select("place", "address").distinct()
    small = one.select("place", F.col("address").alias("small"), F.coalesce(inner["w"], F.lit("")).alias("word"))
    large = one.select("place", F.col("address").alias("large"), F.explode(F.array_union(F.array(F.lit("")), words(F.col("address")))).alias("word"))
    return small.join(large, ["place", "word"]).where((F.length("small") < F.length("large")) & F.contains("large", "small")).select("place", "small", "large")


def filed_pairs(placed: DataFrame, need: list[str], threshold: float) -> list[DataFrame]:
    """The pairs of ``candidates`` among rows with ``need``, ``block`` and ``address``, in parts of two sides ``x`` and ``y``."""
    numbered = placed.select(*need, "block", "address", _numbers(F.col("block"), F.split("address", " +")).alias("listed"))
    known = numbered.select(*need, "block", "address", F.sort_array(F.array_distinct("listed")).alias("tokens"))
    passes = []  # (rooms must be equal, least likeness of addresses)
    for same_rooms, most in ((True, 1.0 - WEIGHTS["address"]), (False, 1.0 - WEIGHTS["address"] - WEIGHTS["rooms"])):
        likeness = (threshold - EASE - most) / WEIGHTS["address"]
        if likeness <= 1:
            passes.append((same_rooms, likeness))
    if not passes:
        raise ValueError("no pair can reach this threshold")
    # (words, how) under which a listing is filed by each pass.
    entries: list[tuple[Column, int]] = []
    for same_rooms, likeness in passes:
        # No word set of this likeness shares less than its size times the likeness.
        first = F.slice("tokens", 1, F.size("tokens") - F.ceil(F.size("tokens") * likeness - EASE).cast("int") + 1)
        if likeness <= 0:
            under, how = F.array(F.lit(0).cast("long")), WHOLE
        elif likeness > 1 - 10 * EASE:
            under, how = F.array(F.xxhash64("tokens")), WHOLE
        else:
            under, how = first, PREFIX
        entries.append((F.when(F.col("bedroom").isNotNull(), under).otherwise(F.slice(under, 1, 0)) if same_rooms else under, how))

    def numbered_entries(i: int) -> Column:
        return F.transform(entries[i][0], lambda w: F.struct(F.lit(i).cast("byte").alias("number"), w.alias("token")))

    def filed() -> DataFrame:
        each = F.concat(*[numbered_entries(i) for i in range(len(entries))])
        flat = known.select("*", F.explode(each).alias("entry")).select(*known.columns, "entry.*")
        rooms = F.when(at_pass([s for s, _ in passes], ""), F.col("bedroom"))
        return flat.withColumn("key", F.xxhash64("number", "block", rooms, "token"))

    col = F.col
    m, n = F.size("x.tokens"), F.size("y.tokens")
    at_pass = lambda values, side="x.": F.get(F.array(*[F.lit(v) for v in values]), col(f"{side}number").cast("int"))
    begin = lambda side, k, least: F.slice(f"{side}.tokens", 1, F.greatest(k - least + 1, F.lit(0)))

    def shared(likeness: Column) -> Column:
        """The first word that a pair shares early enough, else null."""
        sizes_fit = (n >= m * likeness - EASE) & (m >= n * likeness - EASE)
        least = F.ceil(likeness / (1 + likeness) * (m + n) - EASE).cast("int")
        return F.when(sizes_fit, F.get(F.array_intersect(begin("x", m, least), begin("y", n, least)), F.lit(0)))

    alike = F.lit(True)
    if 1.0 - WEIGHTS["area"] < threshold:
        alike = F.abs(col("x.area") - col("y.area")) <= F.greatest("x.area", "y.area") * (STEPS[-1][0] + 1e-9)
    same_rooms = F.coalesce(col("x.bedroom") == col("y.bedroom"), F.lit(False))
    taken = (at_pass([h for _, h in entries]) == WHOLE) | (F.coalesce(shared(at_pass([float(v) for _, v in passes])) == col("x.token"), F.lit(False)))
    # What is cheap comes first; both sides are the same rows by the same columns, which are dealt out once.
    on = reduce(Column.__and__, [col(f"x.{c}") == col(f"y.{c}") for c in ("key", "token", "block", "number")]) & (same_rooms == at_pass([s for s, _ in passes]))
    parts = [filed().alias("x").join(filed().alias("y"), on & (col("x.listing_key") < col("y.listing_key")) & alike & taken)]

    # Pairs of an address and one that contains it, but for those that share a word early enough.
    inside = [(s, v) for (s, v), (_, how) in zip(passes, entries, strict=True) if how == PREFIX and v <= 0.8]
    if inside:
        # The block less the price's bounds, which hold no such sign.
        place = F.left("block", F.length("block") - F.length(F.substring_index("block", "_", -1)) - 1)
        # Stored, so that Spark knows how few they mostly are.
        within = tables.stored(contained(placed.select(place.alias("place"), "address")))
        ends = [within.select(F.col("place").alias("_place"), F.col(c).alias("_address")).distinct() for c in ("small", "large")]
        x, y = (known.join(e, (place == F.col("_place")) & (F.col("address") == F.col("_address")), "left_semi") for e in ends)
        wanted = reduce(Column.__or__, [(same_rooms == s) & shared(F.lit(float(v))).isNull() for s, v in inside])
        here = (col("x.block") == col("y.block")) & (col("x.listing_key") != col("y.listing_key"))
        parts.append(x.alias("x").join(y.alias("y"), here & alike & F.contains("y.address", "x.address") & (col("x.address") != col("y.address")) & wanted))
    return parts


# What the likeness of two listings depends on besides their spots.
PROFILE = ["block", "address", "price", "area", "bedroom"]
REACH, CELL = 1001.0, 5000.0  # metres: beyond which a distance counts nothing, and of the cells in which listings are looked for


def profile() -> Column:
    """A name of what ``PROFILE`` holds, null for rows without an address."""
    held = [loose_key(), address(), *[F.col(c) for c in PROFILE[2:]]]
    # Unambiguous, as the block's length stands first and no number holds a bar.
    text = F.concat_ws("|", F.length(held[0]), *[F.coalesce(c.cast("string"), F.lit("")) for c in held])
    return F.when(address() != "", F.unhex(F.md5(text)))


def addressed(rows: DataFrame, *more: str | Column) -> DataFrame:
    """``profile``, the columns of ``PROFILE`` and more of the rows that have an address."""
    return rows.select(profile().alias("profile"), loose_key().alias("block"), address().alias("address"), *PROFILE[2:], *more).where("address <> ''")


def _own() -> Column:
    """The likeness that any two rows of a profile have without their spots."""
    return reduce(Column.__add__, likeness_of_values("x", "x"), F.lit(1.0) * WEIGHTS["address"])


def links(profiles: DataFrame, threshold: float) -> DataFrame:
    """Pairs ``p, q`` of different profiles whose listings can reach the threshold, each once, with the likeness that all of their
    listings have (``known``) and whether it is ``enough``; else a short distance must add to it.

    ``profiles`` has ``profile`` and the columns of ``PROFILE``.  The pairs are found once and stored.
    """
    named = profiles.withColumn("listing_key", F.col("profile"))
    # Addresses are compared where the values reach the threshold with the whole weight of address and distance.  The generator keeps the
    # long expression out of the join's condition, whose code would be too large to be compiled; rounding noise must not decide at the threshold.
    least = threshold - WEIGHTS["distance"] - EASE
    possible = reduce(Column.__add__, likeness_of_values("x", "y")) >= least - WEIGHTS["address"]
    found = F.filter(F.array(F.when(possible, placeless("x", "y", True))), lambda v: v >= least)
    need = ["listing_key", "price", "area", "bedroom"]
    pair = [F.col("x.listing_key").alias("p"), F.col("y.listing_key").alias("q"), F.col("known")]
    parts = [part.select("*", F.explode(found).alias("known")).select(*pair) for part in filed_pairs(named.select(*need, "block", "address"), need, threshold)]
    return tables.stored(reduce(DataFrame.unionByName, parts)).withColumn("enough", F.col("known") >= threshold - 1e-9)


def _cells(spread: float) -> Column:
    """The cells that the space within ``spread`` metres of a spot touches, mostly one or two."""
    lat, lon = F.radians("latitude"), F.radians("longitude")
    ends = lambda c: F.array_distinct(F.array(*[F.floor((c * geo.EARTH_M + d) / CELL) for d in ((-spread, spread) if spread else (0.0,))]))
    x, y, z = (ends(c) for c in (F.cos(lat) * F.cos(lon), F.cos(lat) * F.sin(lon), F.sin(lat)))
    return F.flatten(F.transform(x, lambda a: F.flatten(F.transform(y, lambda b: F.transform(z, lambda c: F.xxhash64(a, b, c))))))


def close(linked: DataFrame, spots: DataFrame, threshold: float) -> DataFrame:
    """Rows ``x`` and ``y`` of ``spots`` (``profile``, ``own``, latitude, longitude and more) that reach the threshold by their distance, with their ``similarity``:
    of two linked profiles, or of one whose ``own`` likeness is not enough.  Those of two profiles meet in one order, those of one in both, and with themselves.

    Rows meet in cells of space only, so that a profile's rows that lie far apart are not paired.
    """
    placed = spots.where("latitude is not null and longitude is not null")
    least = threshold - WEIGHTS["distance"] - EASE
    own = placed.where((F.col("own") >= least) & (F.col("own") < threshold - 1e-9)).select("*", F.col("profile").alias("_q"), F.col("own").alias("known"))
    near = linked.where(~F.col("enough")).select("p", F.col("q").alias("_q"), "known")
    apart = placed.join(near, F.col("profile") == F.col("p")).select(*placed.columns, "_q", "known")
    asks = own.unionByName(apart).select("*", F.explode(_cells(REACH)).alias("_cell")).alias("x")
    met = asks.join(placed.select("*", _cells(0.0)[0].alias("_at")).alias("y"), (F.col("x._q") == F.col("y.profile")) & (F.col("x._cell") == F.col("y._at")))
    return met.select("*", (F.col("x.known") + likeness_of_spots("x", "y")).alias("similarity")).where(F.col("similarity") >= threshold - 1e-9)


# What a profile is made of: texts of few kinds each, which take less room than the address and the block made of them.
SOURCE = ["street", "ward", "district", "province", "price", "area", "bedroom"]


def _held(rows: DataFrame, *more: str) -> DataFrame:
    """The rows with their profile, stored as narrow as they are, and then the likeness to their like (``own``)."""
    columns = dict.fromkeys([*SOURCE, "latitude", "longitude", *more])
    return tables.stored(rows.select(profile().alias("profile"), *columns)).alias("x").withColumn("own", _own())


def _profiles(held: DataFrame, *more: Column) -> DataFrame:
    one = held.groupBy("profile").agg(F.any_value(F.struct(*SOURCE)).alias("of"), *more)
    made = one.select("profile", "of.*", *one.columns[2:])
    return tables.stored(made.select("profile", loose_key().alias("block"), address().alias("address"), *PROFILE[2:], *one.columns[2:]))


def similar_pairs(rows: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``a, b`` (keys, ``a < b``), their ``similarity`` and ranks ``a_rank, b_rank`` of all pairs in a block at or above the threshold.

    Words of addresses are compared once for each profile; copies of a listing meet only in the result's own pairs, where both
    sides are dealt out once.
    """
    held = _held(rows, "listing_key", "score", "processing_timestamp").where("profile is not null")
    linked = links(_profiles(held), threshold)
    members = held.drop(*SOURCE)
    x, y = members.alias("x"), members.alias("y")
    col = F.col
    ordered = col("x.listing_key") < col("y.listing_key")
    alike = members.where(col("own") >= threshold - 1e-9)
    same = alike.alias("x").join(alike.alias("y"), (col("x.profile") == col("y.profile")) & ordered).select("*", col("x.own").alias("known"))
    far = linked.where("enough").select("p", "q", "known")
    apart = far.join(x, col("p") == col("x.profile")).join(y, (col("q") == col("y.profile")) & (col("x.listing_key") != col("y.listing_key")))
    near = close(linked, members, threshold).where(ordered | ((col("x.profile") != col("y.profile")) & (col("x.listing_key") != col("y.listing_key"))))
    turned = col("x.listing_key") > col("y.listing_key")
    rank = lambda side: F.struct(col(f"{side}.score").alias("score"), col(f"{side}.processing_timestamp").alias("processing_timestamp"))
    parts = []
    for found, likeness in ((same, col("known") + likeness_of_spots("x", "y")), (apart, col("known") + likeness_of_spots("x", "y")), (near, col("similarity"))):
        ends = [F.when(turned, of(a)).otherwise(of(b)).alias(name) for name, of, a, b in (
            ("a", lambda s: col(f"{s}.listing_key"), "y", "x"), ("b", lambda s: col(f"{s}.listing_key"), "x", "y"), ("a_rank", rank, "y", "x"), ("b_rank", rank, "x", "y"),
        )]
        parts.append(found.select(*ends[:2], likeness.alias("similarity"), *ends[2:]))
    return reduce(DataFrame.unionByName, parts)


def without_fuzzy(rows: DataFrame, threshold: float = THRESHOLD, keep: list[str] | None = None) -> DataFrame:
    """Rows (or their columns ``keep``) without a similar peer of higher (score, time, then smaller key); keys are unique.

    No pair of rows is made where a profile's likeness suffices: the best row of a profile, or of a spot of it, stands for the others, and
    only the best row can stay where the likeness of its copies suffices; so the rows themselves are not dealt out.
    """
    kept = keep or rows.columns
    # Ordered as (score, time) downwards with nulls last, then by key.
    place = F.struct(F.col("score").isNull(), -F.col("score"), F.col("processing_timestamp").isNull(), -F.unix_micros(F.col("processing_timestamp").cast("timestamp")), F.col("listing_key"))
    more = [c for c in kept if c != "listing_key"]
    every = _held(rows, "listing_key", "score", "processing_timestamp", *kept).withColumn("row", F.struct(F.lit(None).cast("byte").alias("_"), *more))
    held = every.where("profile is not null").withColumn("place", place)
    # Places are different, so what follows them decides nothing.
    profiles = _profiles(held, F.min(F.struct("place", "own", "latitude", "longitude", "row")).alias("best"))
    linked = links(profiles, threshold)
    sure = F.col("own") >= threshold - 1e-9
    both_ways = F.array(F.struct(F.col("p").alias("profile"), F.col("q").alias("by")), F.struct(F.col("q").alias("profile"), F.col("p").alias("by")))
    ends = lambda rows: rows.select(F.explode(both_ways).alias("e")).select("e.*")
    beats = profiles.select(F.col("profile").alias("by"), F.col("best.place").alias("beat"))
    # Stored, as what follows: Spark then knows how few these mostly are, and the files of shuffles that led there are gone.
    whole = tables.stored(ends(linked.where("enough")).join(beats, "by").groupBy("profile").agg(F.min("beat").alias("_by_profile")))
    # Spots are needed of rows whose copies must be near, and of those on a link that asks for a short distance.
    asked = tables.stored(ends(linked.where(~F.col("enough"))).select("profile").distinct())
    sited = held.select("profile", "own", "latitude", "longitude", "place")
    alone = ~sure & (F.col("own") >= threshold - WEIGHTS["distance"] - EASE)
    spots = sited.where(alone).unionByName(sited.where(~alone).join(asked, "profile", "left_semi"))
    spots = tables.stored(spots.where("latitude is not null and longitude is not null").groupBy("profile", "own", "latitude", "longitude").agg(F.min("place").alias("beat")))
    end = lambda of, by: F.struct(*[F.col(f"{of}.{c}").alias(c) for c in ("profile", "latitude", "longitude")], F.col(f"{by}.beat").alias("beat"))
    local = close(linked, spots, threshold).select(F.explode(F.array(end("x", "y"), end("y", "x"))).alias("e")).select("e.*")
    local = tables.stored(local.groupBy("profile", "latitude", "longitude").agg(F.min("beat").alias("_by_spot")))
    # What may stay: the best rows of profiles whose copies are alike enough, all rows of the others.
    may = profiles.select("profile", "best.*").where(sure).unionByName(held.where(~sure).select("profile", "place", "own", "latitude", "longitude", "row"))
    lost = lambda by: F.coalesce(F.col(by) < F.col("place"), F.lit(False))
    left = may.join(whole, "profile", "left").where(~lost("_by_profile"))
    left = left.join(local, ["profile", "latitude", "longitude"], "left").where(~lost("_by_spot"))
    row = lambda key: [F.col(key).alias("listing_key") if c == "listing_key" else F.col(f"row.{c}").alias(c) for c in kept]
    return left.select(*row("place.listing_key")).unionByName(every.where("profile is null").select(*row("listing_key")))


def feature_key() -> Column:
    """Coordinates to four places, area, price in millions, ids and rooms, all as integers."""
    parts = [rounded(F.col("latitude") * 1e4), rounded(F.col("longitude") * 1e4), rounded(F.col("area")), rounded(F.col("price") / 1e6)]
    parts += [F.coalesce(F.col(c), F.lit(-1)).cast("long") for c in ("province_id", "district_id", "bedroom", "bathroom")]
    return F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts]))


def grid_key() -> list[Column]:
    scaled = [rounded(F.col("latitude") * 20000), rounded(F.col("longitude") * 20000), rounded(F.col("area") / 10), rounded(F.col("price") / 5e7)]
    return scaled + [F.coalesce(F.col(c), F.lit(-1)) for c in ("bedroom", "bathroom", "floor_count", "province_id", "district_id")]


def completeness() -> Column:
    present = [F.col(c).isNotNull() for c in ("price", "area", "latitude", "longitude")] + [F.coalesce(F.col(c) > 0, F.lit(False)) for c in ("bedroom", "bathroom")]
    total = F.lit(0)
    for p in present:
        total = total + p.cast("int")
    return total


def conflicts(new: DataFrame, existing: DataFrame) -> DataFrame:
    """Id matches and matches by place, price (15 %), area (20 m²) and rooms, as ``new_*`` and ``existing_*`` columns."""
    n = new.select(*[F.col(c).alias(f"new_{c}") for c in new.columns])
    e = existing.select(*[F.col(c).alias(f"existing_{c}") for c in existing.columns])
    col = F.col
    same = lambda c: col(f"new_{c}") == col(f"existing_{c}")
    by_id = n.join(e, same("id")).withColumn("conflict_type", F.lit("ID_MATCH"))
    both_null = lambda c: col(f"new_{c}").isNull() & col(f"existing_{c}").isNull()
    price = both_null("price") | (F.abs(col("new_price") - col("existing_price")) / F.greatest(col("existing_price"), F.lit(1.0)) <= 0.15)
    area = both_null("area") | (F.abs(col("new_area") - col("existing_area")) <= 20)
    rooms = col("new_bedroom").eqNullSafe(col("existing_bedroom")) & col("new_bathroom").eqNullSafe(col("existing_bathroom"))
    place = same("province") & same("district") & same("ward") & same("street")
    by_place = n.join(e, place & rooms & price & area & (col("new_id") != col("existing_id"))).withColumn("conflict_type", F.lit("LOCATION_MATCH"))
    return by_id.unionByName(by_place)


def resolution() -> Column:
    """What to do with the new row of a conflict."""
    n, e = F.coalesce(F.col("new_score"), F.lit(0)), F.coalesce(F.col("existing_score"), F.lit(0))
    known = F.col("new_score").isNotNull() & F.col("existing_score").isNotNull()
    newer = F.col("new_processing_timestamp") > F.col("existing_processing_timestamp")
    return (
        F.when(known & (n - e >= 20), "USE_NEW").when(known & (e - n >= 20), "SKIP_NEW")
        .when((F.col("new_source") != F.col("existing_source")) & (F.abs(n - e) < 20), "USE_NEW")
        .when((F.col("new_source") == F.col("existing_source")) & newer, "USE_NEW").otherwise("SKIP_NEW")
    )


def resolved(new: DataFrame, found: DataFrame) -> DataFrame:
    """New rows no conflict of which says skip."""
    skip = found.where(resolution() == "SKIP_NEW").select(F.col("new_id").alias("id")).distinct()
    return new.join(skip, "id", "left_anti")
