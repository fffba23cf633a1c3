"""Polygons as well-known binary, as column expressions. Numbers are written low byte first and read in either order."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from fleetspark.functions.geo import bound

# Geometry codes, and the layout of a double (52 bits of fraction, exponents offset by 1023).
POLYGON, MULTI_POLYGON = 3, 6
FRACTION_BITS, OFFSET, SMALLEST = 52, 1023, -1022
POINT_BYTES = 16


def _reversed(digits: Column, size: int) -> Column:
    """The bytes of a hex text of ``size`` bytes, last byte first."""
    return F.concat(*(F.substring(digits, 2 * i + 1, 2) for i in range(size - 1, -1, -1)))


def _power(exponent: Column) -> Column:
    return F.pow(F.lit(2.0), exponent.cast("double"))


def _count(n: Column) -> Column:
    return _reversed(F.lpad(F.hex(n.cast("bigint")), 8, "0"), 4)


def _number(x: Column) -> Column:
    """A finite double as 16 hex digits, low byte first. Zeros have no sign, and numbers below 2**-1022 become zero.

    Powers of two and the division by them are exact, so the fraction is too.
    """
    size = F.abs(x)

    def exponent(guess: Column) -> Column:
        # The logarithm may be off by one next to a power of two.
        return F.when(_power(guess) > size, guess - 1).when(_power(guess + 1) <= size, guess + 1).otherwise(guess)

    def bits(e: Column) -> Column:
        fraction = ((size / _power(e) - 1) * float(2**FRACTION_BITS)).cast("bigint")
        return (e.cast("bigint") + OFFSET) * 2**FRACTION_BITS + fraction

    low = F.floor(F.log2(size)).cast("int")
    positive = F.when(size < 2.0**SMALLEST, F.lit(0).cast("bigint")).otherwise(bound(bound(low, exponent), bits))
    signed = bound(positive, lambda p: F.when((x < 0) & (p > 0), p + F.lit(-(2**63))).otherwise(p))
    return bound(F.lpad(F.hex(signed), 16, "0"), lambda digits: _reversed(digits, 8))


def _ring(ring: Column) -> Column:
    """A ring's points; one that does not end where it began is closed."""
    first, last = F.get(ring, F.lit(0)), F.element_at(ring, -1)
    closed = F.when(F.size(ring) == 0, ring).when((first.x == last.x) & (first.y == last.y), ring).otherwise(
        F.concat(ring, F.slice(ring, 1, 1)))
    points = lambda r: F.array_join(F.transform(r, lambda p: F.concat(_number(p.x), _number(p.y))), "")
    return bound(closed, lambda r: F.concat(_count(F.size(r)), points(r)))


def _head(kind: int) -> str:
    return "01" + kind.to_bytes(4, "little").hex().upper()


def _polygon(rings: Column) -> Column:
    return F.concat(F.lit(_head(POLYGON)), _count(F.size(rings)), F.array_join(F.transform(rings, _ring), ""))


def polygon_wkb(rings: Column, parts: Column, multi: Column) -> Column:
    """Rings (array<array<struct<x,y>>>) as a polygon, or with ``multi`` as a multi-polygon of their ``parts`` (0, 1, ...).

    Null where a ring or a coordinate is null or a coordinate is not finite. Without rings the geometry is empty.
    """
    infinite = F.lit(float("inf"))
    # Not a number counts as larger than infinity.
    fits = lambda x: F.coalesce(F.abs(x) < infinite, F.lit(False))
    whole = F.forall(rings, lambda ring: ring.isNotNull() & F.forall(ring, lambda p: p.isNotNull() & fits(p.x) & fits(p.y)))
    numbers = F.when(F.size(rings) == 0, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(0), F.array_max(parts)))
    own = lambda k: F.filter(rings, lambda ring, i: F.get(parts, i) == k)
    several = F.concat(F.lit(_head(MULTI_POLYGON)), _count(F.size(numbers)), F.array_join(F.transform(numbers, lambda k: _polygon(own(k))), ""))
    return F.when(whole, F.unhex(F.when(multi, several).otherwise(_polygon(rings))))


def wkb_rings(area: Column) -> Column:
    """struct(rings, parts, multi) of a polygon or multi-polygon; null for anything else and for broken bytes.

    A first pass notes where rings begin, so numbers are cut out of the bytes once; closing points stay.
    """

    def digits(area: Column, at: Column, size: int, low_first: Column) -> Column:
        return bound(F.hex(F.substring(area, at, F.lit(size))), lambda h: F.when(low_first, _reversed(h, size)).otherwise(h))

    def count(area: Column, at: Column, low_first: Column) -> Column:
        return F.coalesce(F.conv(digits(area, at, 4, low_first), 16, 10).cast("bigint"), F.lit(0).cast("bigint"))

    def low_first(area: Column, at: Column) -> Column:
        return F.hex(F.substring(area, at, F.lit(1))) == "01"

    def number(area: Column, at: Column, low: Column) -> Column:
        def value(h: Column) -> Column:
            head = F.conv(F.substring(h, 1, 3), 16, 10).cast("int")
            fraction = F.conv(F.substring(h, 4, 13), 16, 10).cast("bigint")
            e = head % (2 * (OFFSET + 1))
            size = F.when(e == 0, fraction.cast("double") * 2.0**SMALLEST * 2.0**-FRACTION_BITS).otherwise(
                (fraction + 2**FRACTION_BITS).cast("double") * _power(e - OFFSET - FRACTION_BITS))
            return F.when(head > e, -size).otherwise(size)

        return bound(digits(area, at, 8, low), value)

    def up_to(area: Column, n: Column) -> Column:
        """1..n; a count that the bytes cannot hold is cut, and found out by the length afterwards."""
        fitting = F.least(n, F.length(area).cast("bigint")).cast("int")
        return F.when(fitting > 0, F.sequence(F.lit(1), fitting)).otherwise(F.array().cast("array<int>"))

    def polygon(area: Column, state: Column, part: Column) -> Column:
        low = low_first(area, state.at)
        start = F.struct((state.at + 9).alias("at"), state.found.alias("found"))

        def ring(s: Column, _: Column) -> Column:
            return bound(count(area, s.at, low), lambda n: F.struct(
                (s.at + 4 + n * POINT_BYTES).alias("at"),
                F.concat(s.found, F.array(F.struct(part.cast("int").alias("part"), (s.at + 4).alias("at"), n.alias("n"), low.alias("low")))).alias("found")))

        # A part that is no polygon ends the search: its place lies beyond every length.
        kind = count(area, state.at + 1, low)
        return F.when(kind == POLYGON, F.aggregate(up_to(area, count(area, state.at + 5, low)), start, ring)).otherwise(
            F.struct(F.lit(2**40).cast("bigint").alias("at"), state.found.alias("found")))

    def read(area: Column) -> Column:
        one = F.lit(1).cast("bigint")
        low = low_first(area, one)
        kind = count(area, F.lit(2).cast("bigint"), low)
        none = F.array().cast("array<struct<part:int,at:bigint,n:bigint,low:boolean>>")
        begin = lambda at: F.struct(F.lit(at).cast("bigint").alias("at"), none.alias("found"))
        several = F.aggregate(up_to(area, count(area, F.lit(6).cast("bigint"), low)), begin(10), lambda s, i: polygon(area, s, i - 1))
        found = F.when(kind == POLYGON, polygon(area, begin(1), F.lit(0))).when(kind == MULTI_POLYGON, several)

        def points(r: Column) -> Column:
            place = lambda i: r.at + (i - 1) * POINT_BYTES
            return F.transform(up_to(area, r.n), lambda i: F.struct(
                number(area, place(i), r.low).alias("x"), number(area, place(i) + 8, r.low).alias("y")))

        return bound(found, lambda f: F.when(f.at == F.length(area) + 1, F.struct(
            F.transform(f.found, points).alias("rings"), F.transform(f.found, lambda r: r.part).alias("parts"),
            (kind == MULTI_POLYGON).alias("multi"))))

    return bound(area, read)
