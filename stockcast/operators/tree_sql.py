"""Fitted tree ensembles as SQL text, so that scoring is one projection without vectors or functions of the model."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.ml.regression import DecisionTreeRegressionModel, GBTRegressionModel

from stockcast.functions import sqltext as sql

TREES_PER_EXPRESSION = 2  # a compiled expression of two trees of depth 6 stays within what the JVM optimizes
_TEST = re.compile(r"If \(feature (\d+) (<=|in) (.+)\)$")


def tree_sql(tree: DecisionTreeRegressionModel, columns: Sequence[str]) -> str:
    """One tree as nested IF over ``columns`` (doubles, not null), in the order of its feature numbers."""
    lines = [line.strip() for line in tree.toDebugString.splitlines()[1:] if line.strip()]
    at = 0

    def node() -> str:
        nonlocal at
        line = lines[at]
        at += 1
        if line.startswith("Predict: "):
            return f"{line.removeprefix('Predict: ')}D"
        number, kind, what = _TEST.match(line).groups()
        column = sql.name(columns[int(number)])
        values = [f"{v.strip()}D" for v in what.strip("{}").split(",")]
        test = f"{column} <= {values[0]}" if kind == "<=" else f"{column} IN ({', '.join(values)})"
        left = node()
        at += 1  # the line of the other branch
        return f"IF({test}, {left}, {node()})"

    return node()


def ensemble_sql(model: GBTRegressionModel, columns: Sequence[str]) -> list[str]:
    """Parts whose sum is the prediction: weighted trees, a few in each."""
    terms = [f"{sql.double(w)} * {tree_sql(t, columns)}" for t, w in zip(model.trees, model.treeWeights)]
    return [" + ".join(terms[i:i + TREES_PER_EXPRESSION]) for i in range(0, len(terms), TREES_PER_EXPRESSION)]
