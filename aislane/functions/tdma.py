"""Slot arithmetic of the 2250-slot TDMA frame."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from aislane.functions.constants import (
    INCREMENT_BELOW_KNOTS,
    INCREMENT_FAST,
    SLOT_TOLERANCE,
    SLOTS_PER_FRAME,
    SPEED_UNITS_PER_KNOT,
)


def nominal_increment(sog: Column) -> Column:
    """Slots between two reports at this speed (tenths of a knot); NULL at rest."""
    knots = sog / SPEED_UNITS_PER_KNOT
    steps = F.when(knots.isNull() | (knots == 0), F.lit(None).cast("int"))
    for below, slots in INCREMENT_BELOW_KNOTS:
        steps = steps.when(knots < below, F.lit(slots))
    return steps.otherwise(F.lit(INCREMENT_FAST))


def slot_distance(previous: Column, current: Column) -> Column:
    """Slots from previous to current, round the end of the frame if needed."""
    step = current - previous
    return F.when(step < 0, step + SLOTS_PER_FRAME).otherwise(step)


def within_tolerance(distance: Column, increment: Column) -> Column:
    """True or false, or NULL where either side is unknown."""
    margin = increment * SLOT_TOLERANCE
    return distance.between(increment - margin, increment + margin)
