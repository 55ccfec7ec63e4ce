"""A two-class model in a session that observes: its training summary holds the session, which tasks cannot take."""

from pyspark.sql import Observation
from pyspark.sql import functions as F

from lexflume.operators import models


def test_two_classes_after_an_observation(frame):
    rows = frame([(i % 2, f"w{i % 2} v{i % 5}") for i in range(40)], "label int, text string")
    seen = Observation()
    assert rows.observe(seen, F.count(F.lit(1)).alias("n")).count() == 40 and seen.get["n"] == 40
    model = models.train_classifier(rows, rows, grid=(0.1,), max_iter=5)
    scored = models.score_classifier(rows, model).select("label", "logits").collect()
    assert all((r["logits"][1] > r["logits"][0]) == (r["label"] == 1) for r in scored)
