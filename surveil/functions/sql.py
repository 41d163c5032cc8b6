"""SQL functions: the universe rules and a fitted scorer, callable from ``spark.sql``.

The rules are SQL functions with declared types, so Catalyst inlines them; the
scorer is an Arrow function of all features as an array.  All are temporary:
they live in the session that registers them.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from surveil.functions.constants import (
    MARKET_CAP_BINS, MARKET_CAP_LABELS, SYMBOL_BAD_CHARS, SYMBOL_BAD_SUFFIXES, SYMBOL_MAX_LENGTH)


def _tier_sql(x: str) -> str:
    edges = zip(MARKET_CAP_BINS[:-1], MARKET_CAP_BINS[1:], MARKET_CAP_LABELS)
    number = lambda v: f"DOUBLE('{v}')"
    return "CASE " + " ".join(f"WHEN {x} >= {number(a)} AND {x} < {number(b)} THEN '{label}'" for a, b, label in edges) + " ELSE 'nan' END"


def register_universe(spark: SparkSession) -> list[str]:
    """``normal_symbol(s)``, ``is_common_stock(symbol, test_issue, etf)``, ``market_cap_tier(x)`` (U2, U3, F15); their names."""
    ends = " OR ".join(f"endswith(normal_symbol(symbol), '{c}')" for c in SYMBOL_BAD_SUFFIXES)
    functions = {
        "normal_symbol": ("s STRING", "STRING", "upper(trim(s))"),
        "is_common_stock": (
            "symbol STRING, test_issue STRING, etf STRING", "BOOLEAN",
            f"coalesce(test_issue, '') <> 'Y' AND coalesce(etf, '') <> 'Y' AND coalesce(length(normal_symbol(symbol)) BETWEEN 1 AND "
            f"{SYMBOL_MAX_LENGTH} AND NOT (rlike(normal_symbol(symbol), '{SYMBOL_BAD_CHARS}') OR {ends}), false)"),
        "market_cap_tier": ("market_cap DOUBLE", "STRING", _tier_sql("coalesce(market_cap, 0)")),
    }
    for name, (arguments, kind, body) in functions.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS {kind} RETURN {body}")
    return list(functions)


def register_scorer(spark: SparkSession, model, name: str = "fraud_proba") -> list[str]:
    """``name(features ARRAY<DOUBLE>)``: P(fraud) of a fitted model (M12); the features are those it was fitted to, in order."""
    from surveil.operators import forest as fr
    from surveil.operators.model import _tree_nodes
    from surveil.session import ship_package

    ship_package(spark)
    nodes = model.forest_nodes.toPandas()  # the node tables of a model, which tasks load whole
    given = spark.sparkContext.broadcast((fr.Forest.from_nodes(nodes), model.scorer, model.fill, np.array(_tree_nodes(model.tree))))

    @F.pandas_udf("double")
    def proba(features: pd.Series) -> pd.Series:
        forest, scorer, fill, tree = given.value
        known = features.notna().to_numpy()
        out = np.full(len(features), np.nan)
        if known.any():
            x = np.stack([np.asarray(v, dtype=float) for v in features[known]])
            filled = lambda s: np.where(np.isnan(x[:, s.index]), np.array(s.median), x[:, s.index])
            score = forest.score((filled(scorer) - np.array(scorer.center)) / np.array(scorer.scale))
            v = np.column_stack([filled(fill), score])
            at = np.zeros(len(v), dtype=np.int64)
            while (inner := np.flatnonzero(tree[at, 1] >= 0)).size:
                n = tree[at[inner]]
                low = v[inner, n[:, 1].astype(np.int64)] <= n[:, 2]
                at[inner] = np.where(low, n[:, 3], n[:, 4]).astype(np.int64)
            out[known] = tree[at, 6]
        return pd.Series(out).where(known, None)

    spark.udf.register(name, proba)
    return [name]
