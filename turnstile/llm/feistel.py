"""Feistel networks as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def on_pairs(x: Column, a: int, b: int, rounds: int, mix: Callable[[Column, Column], Column]) -> Column:
    """A permutation of 0 to a * b - 1: the number is a pair (x div b, x mod b).

    Each round shifts one half by ``mix(other half, round)``, any long, modulo
    its own range; that can be undone, whatever ``mix`` is.
    """

    def step(pair: Column, r: Column) -> Column:
        left, right = pair["left"], pair["right"]
        even = F.pmod(r, F.lit(2)) == 0
        shift = mix(F.when(even, right).otherwise(left), r)
        moved_left = F.when(even, F.pmod(left + F.pmod(shift, F.lit(a)), F.lit(a))).otherwise(left)
        moved_right = F.when(even, right).otherwise(F.pmod(right + F.pmod(shift, F.lit(b)), F.lit(b)))
        return F.struct(moved_left.cast("long").alias("left"), moved_right.cast("long").alias("right"))

    pair = F.struct(F.floor(x / F.lit(b)).cast("long").alias("left"), F.pmod(x, F.lit(b)).cast("long").alias("right"))
    return F.aggregate(F.array(*[F.lit(r) for r in range(rounds)]), pair, step, lambda p: p["left"] * F.lit(b) + p["right"])


def on_signs(value: Column, alphabets: tuple[str, ...], rounds: int, mix: Callable[[Column, Column, Column], Column]) -> Column:
    """A permutation of texts of one format: every sign moves within its alphabet, others stand.

    The halves of the text shift each other: sign i of one half by ``mix(other
    half, i, round)``.
    """

    def moved(half: Column, other: Column, r: Column) -> Column:
        def sign(i: Column) -> Column:
            c, shift = F.substring(half, i, F.lit(1)), mix(other, i, r)
            out = None
            for alphabet in alphabets:
                at = F.instr(F.lit(alphabet), c)
                new = F.substring(F.lit(alphabet), (F.pmod(at - 1 + F.pmod(shift, F.lit(len(alphabet))), F.lit(len(alphabet))) + 1).cast("int"), F.lit(1))
                out = F.when(at > 0, new) if out is None else out.when(at > 0, new)
            return out.otherwise(c)

        places = F.when(F.char_length(half) > 0, F.sequence(F.lit(1), F.char_length(half))).otherwise(F.array().cast("array<int>"))
        return F.array_join(F.transform(places, sign), "")

    def step(text: Column, r: Column) -> Column:
        n = F.char_length(text)
        middle = F.floor(n / 2).cast("int")
        left, right = F.substring(text, F.lit(1), middle), F.substring(text, middle + 1, n)
        return F.when(F.pmod(r, F.lit(2)) == 0, F.concat(moved(left, right, r), right)).otherwise(F.concat(left, moved(right, left, r)))

    return F.aggregate(F.array(*[F.lit(r) for r in range(rounds)]), value, step)
