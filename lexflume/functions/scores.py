"""Model scores: logits, probabilities, class names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexflume.constants import CLASS_NAMES


def softmax(logits: Column) -> Column:
    """Logits to probabilities, shifted by the highest so that exp cannot overflow."""
    top = F.array_max(logits)
    weights = F.transform(logits, lambda x: F.exp(x - top))
    total = F.aggregate(weights, F.lit(0.0), lambda a, x: a + x)
    return F.transform(weights, lambda w: w / total)


def argmax(scores: Column) -> Column:
    """Index of the highest score, the first one on a tie."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def class_name(label: Column) -> Column:
    """Class id to class name; null for an unknown id."""
    named = F.lit(None).cast("string")
    for class_id, name in reversed(CLASS_NAMES.items()):
        named = F.when(label == class_id, F.lit(name)).otherwise(named)
    return named


def named_probabilities(probabilities: Column) -> Column:
    """Probability array to a class name -> probability map."""
    return F.map_from_arrays(F.array(*[F.lit(n) for n in CLASS_NAMES.values()]), probabilities)
