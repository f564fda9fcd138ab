"""Search for a forest by successive halving over nested samples of the training rows."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pointlab.functions import exact_fraction, key_bound
from pointlab.operators.forest import forest


@dataclass
class Rung:
    """What was fitted on one sample: its fraction and rows, and the accuracy of each candidate by its place in the grid."""

    fraction: Decimal
    rows: int
    accuracy: dict[int, float]
    kept: list[int] = field(default_factory=list)


@dataclass
class Halving:
    rungs: list[Rung]
    best: dict
    model: RandomForestClassificationModel

    @property
    def rows_trained(self) -> int:
        """Rows over all fits, which is what a search costs."""
        return sum(rung.rows * len(rung.accuracy) for rung in self.rungs)


def halving_search(train: DataFrame, val: DataFrame, grid: Sequence[dict], *, key: str = "sample_key", start: float | str | Decimal = "0.25",
                   factor: int = 2, label: str = "Classification", **params) -> Halving:
    """Fit every candidate of ``grid`` (forest parameters) on a small sample, go on with the better ones on a larger one.

    ``train`` has the assembled features, the label and ``key``, the point key of each row; the sample of a rung
    are the rows below a bound of the key, so each sample lies inside the next. The share of candidates that goes on is
    ``1 / factor`` (rounded up), the sample grows by ``factor`` up to all rows. All candidates of a rung score the
    validation rows in one pass; ties go to the first. The last one standing is returned as fitted on all rows.
    """
    if not grid or factor < 2:
        raise ValueError("a grid with candidates and a factor of at least 2 are needed")
    fractions = [exact_fraction(start)]
    while fractions[-1] < 1:
        fractions.append(min(Decimal(1), fractions[-1] * factor))
    labelled = train.where(F.col(label).isNotNull())
    counts = labelled.agg(*[F.count_if(F.col(key) < key_bound(f)).alias(f"n{i}") for i, f in enumerate(fractions)]).first()
    scored_rows = val.where(F.col(label).isNotNull())
    rungs, left, model = [], list(range(len(grid))), None
    for i, fraction in enumerate(fractions):
        last = i == len(fractions) - 1
        rows = labelled if last else labelled.where(F.col(key) < key_bound(fraction))
        models = {c: forest(label, **{**params, **grid[c]}).fit(rows) for c in left}
        scored = scored_rows
        for c, fitted in models.items():
            scored = fitted.copy().setPredictionCol(f"candidate_{c}").setRawPredictionCol("").setProbabilityCol("").transform(scored)
        hits = scored.agg(*[F.avg((F.col(f"candidate_{c}") == F.col(label)).cast("double")).alias(f"c{c}") for c in left]).first()
        rung = Rung(fraction, counts[f"n{i}"], {c: hits[f"c{c}"] or 0.0 for c in left})
        rungs.append(rung)
        ordered = sorted(left, key=lambda c: (-rung.accuracy[c], c))
        rung.kept = ordered[: 1 if last else math.ceil(len(ordered) / factor)]
        left = sorted(rung.kept)
        model = models[rung.kept[0]]
    return Halving(rungs, dict(grid[left[0]]), model)
