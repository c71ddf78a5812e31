"""Perceptron with two hidden layers as column expressions (O-49).

Hidden units are rectified, the output is logistic.  Scoring is one projection
per layer.  A training step is one pass over the rows: each row's gradients come
by back propagation as columns and are summed in one grouped aggregate (about 200
sums for 16 and 8 units), so a step sends one row to the driver whatever the
table's size.  Steps are Adam steps on the whole table with an L2 term, on the
mean logistic loss; the original's mini-batches of 200 rows have no order that a
distributed table could share.
"""

from __future__ import annotations

import random
from collections.abc import Sequence
from dataclasses import dataclass
from math import sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

HIDDEN = (16, 8)


@dataclass
class Perceptron:
    """``weights[l][i][j]`` from unit i of layer l to unit j of the next, and
    ``biases[l][j]``."""
    weights: list[list[list[float]]]
    biases: list[list[float]]

    @classmethod
    def start(cls, n_features: int, hidden: Sequence[int] = HIDDEN, seed: int = 42) -> "Perceptron":
        """Fixed start weights: uniform within sqrt(6 / (units before + after))
        (sqrt(2 / ...) before the output), repeatable by ``seed``."""
        draw = random.Random(seed)
        sizes = [n_features, *hidden, 1]
        weights, biases = [], []
        for layer, (a, b) in enumerate(zip(sizes, sizes[1:])):
            bound = sqrt((2 if layer == len(hidden) else 6) / (a + b))
            weights.append([[draw.uniform(-bound, bound) for _ in range(b)] for _ in range(a)])
            biases.append([draw.uniform(-bound, bound) for _ in range(b)])
        return cls(weights, biases)

    def flat(self) -> list[float]:
        return [v for w, b in zip(self.weights, self.biases) for v in [*(x for row in w for x in row), *b]]

    def with_values(self, values: Sequence[float]) -> "Perceptron":
        it = iter(values)
        pairs = [([[next(it) for _ in row] for row in w], [next(it) for _ in b]) for w, b in zip(self.weights, self.biases)]
        return Perceptron([w for w, _ in pairs], [b for _, b in pairs])


def _unit(layer: int, j: int) -> str:
    return f"_m{layer}_{j}"


def _sum(terms: list[Column]) -> Column:
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def with_units(df: DataFrame, model: Perceptron, features: Sequence[str], out: str = "score") -> DataFrame:
    """``df`` plus the columns of all hidden units and ``out``, the output."""
    before = [F.col(c) for c in features]
    for layer, (w, b) in enumerate(zip(model.weights, model.biases), 1):
        sums = [_sum([F.lit(b[j])] + [x * F.lit(w[i][j]) for i, x in enumerate(before)]) for j in range(len(b))]
        if layer == len(model.weights):
            return df.withColumn(out, 1 / (1 + F.exp(-sums[0])))
        df = df.withColumns({_unit(layer, j): F.greatest(s, F.lit(0.0)) for j, s in enumerate(sums)})
        before = [F.col(_unit(layer, j)) for j in range(len(b))]
    raise ValueError("a perceptron needs a layer")


def score(df: DataFrame, model: Perceptron, features: Sequence[str], out: str = "score",
          carry: Sequence[str] | None = None) -> DataFrame:
    """``df`` (or its columns ``carry``) plus ``out``, the chance of class 1; a
    null feature gives a null score."""
    return with_units(df, model, features, out).select(*(carry or df.columns), out)


def gradients(df: DataFrame, model: Perceptron, features: Sequence[str], label: str = "label"):
    """(rows, mean loss, sums of gradients in the order of ``flat``), one pass."""
    layers = len(model.weights)
    rows = with_units(df, model, features, "_p").withColumn(f"_d{layers}_0", F.col("_p") - F.col(label))
    for layer in range(layers - 1, 0, -1):
        w = model.weights[layer]
        rows = rows.withColumns({f"_d{layer}_{i}": F.when(F.col(_unit(layer, i)) > 0, _sum(
            [F.col(f"_d{layer + 1}_{j}") * F.lit(v) for j, v in enumerate(w[i])])).otherwise(0.0) for i in range(len(w))})
    sums = []
    for layer, (w, b) in enumerate(zip(model.weights, model.biases), 1):
        inputs = [F.col(c) for c in features] if layer == 1 else [F.col(_unit(layer - 1, i)) for i in range(len(w))]
        sums += [F.sum(x * F.col(f"_d{layer}_{j}")) for x in inputs for j in range(len(b))]
        sums += [F.sum(f"_d{layer}_{j}") for j in range(len(b))]
    p = F.least(F.greatest("_p", F.lit(1e-15)), F.lit(1 - 1e-15))
    loss = F.avg(-(F.col(label) * F.log(p) + (1 - F.col(label)) * F.log(1 - p)))
    row = rows.agg(F.count("_p"), loss, *sums).first()
    return row[0], row[1], list(row[2:])


def fit(df: DataFrame, features: Sequence[str], label: str = "label", steps: int = 500, rate: float = 0.001,
        alpha: float = 0.001, start: Perceptron | None = None, tol: float = 1e-4, patience: int = 10
        ) -> tuple[Perceptron, list[float]]:
    """The model after at most ``steps`` Adam steps and the loss before each.
    Training ends early when the loss has not fallen by ``tol`` for ``patience``
    steps.  Rows with a null feature or label are left out; without any row a
    ValueError is raised."""
    rows = df.select(*[F.col(c).cast("double").alias(c) for c in features], F.col(label).cast("double").alias(label))
    rows = materialize(rows.na.drop())
    model = start or Perceptron.start(len(features))
    values = model.flat()
    penalised = model.with_values([1.0] * len(values))
    penalised.biases = [[0.0] * len(b) for b in penalised.biases]
    alphas = [alpha * v for v in penalised.flat()]
    m, v = [0.0] * len(values), [0.0] * len(values)
    losses, best, waited = [], float("inf"), 0
    for step in range(1, steps + 1):
        n, loss, sums = gradients(rows, model, features, label)
        if not n:
            raise ValueError("no complete training row")
        loss += sum(a * x * x for a, x in zip(alphas, values)) / (2 * n)
        losses.append(loss)
        waited, best = (0 if loss < best - tol else waited + 1), min(best, loss)
        if waited >= patience:
            break
        scale = rate * sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
        for i, s in enumerate(sums):
            g = (s + alphas[i] * values[i]) / n
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.999 * v[i] + 0.001 * g * g
            values[i] -= scale * m[i] / (sqrt(v[i]) + 1e-8)
        model = model.with_values(values)
    return model, losses


def score_sql(model: Perceptron, features: Sequence[str], source: str, carry: Sequence[str]) -> list[str]:
    """CTEs ``mlp1`` ... of the same sums in SQL; the last has ``carry`` and ``score``."""
    out, before, names = [], list(features), [*carry]
    for layer, (w, b) in enumerate(zip(model.weights, model.biases), 1):
        sums = ["({!r}::DOUBLE{})".format(b[j], "".join(f" + {x} * {w[i][j]!r}::DOUBLE" for i, x in enumerate(before)))
                for j in range(len(b))]
        if layer == len(model.weights):
            out.append(f"mlp{layer} AS (SELECT {', '.join(names)}, 1 / (1 + exp(-{sums[0]})) AS score FROM {source})")
        else:
            units = ", ".join(f"greatest({s}, 0.0::DOUBLE) AS u{layer}_{j}" for j, s in enumerate(sums))
            out.append(f"mlp{layer} AS (SELECT {', '.join(names)}, {units} FROM {source})")
        source, before = f"mlp{layer}", [f"u{layer}_{j}" for j in range(len(b))]
    return out
