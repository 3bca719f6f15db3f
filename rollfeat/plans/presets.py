"""The two shipped feature sets, and how a feature table is put together."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollfeat.functions.scalars import weekday_name
from rollfeat.operators.hotkeys import Limits
from rollfeat.operators.rolling import RollingBlock, with_rolling


@dataclass(frozen=True)
class Preset:
    name: str
    blocks: tuple[RollingBlock, ...]
    created_timestamp: bool

    @property
    def max_lookback(self) -> int:
        return max(b.max_lookback for b in self.blocks)

    @property
    def feature_names(self) -> list[str]:
        return [f.name for b in self.blocks for f in b.features()]

    def summing_in(self, exact_type: str) -> Preset:
        """The same features with floating-point amounts summed in a decimal type."""
        return replace(self, blocks=tuple(replace(b, exact_type=exact_type) for b in self.blocks))


# Amounts that are not decimals are summed in this type; ``summing_in`` gives another.
MONEY = "decimal(18,2)"

# The look-backs and aggregations of the two feature sets.
PRESET_A = Preset(
    "preset_a",
    (
        RollingBlock(["count", "avg", "min"], ["tx_amount"], ["customer_id"], ["1h", "5d", "28d", "90d", "95d"], exact_type=MONEY),
        RollingBlock(["max"], ["tx_amount"], ["terminal_id"], ["1h", "3d", "28d", "90d", "175d"]),
    ),
    created_timestamp=True,
)
PRESET_B = Preset(
    "preset_b",
    (
        RollingBlock(["count", "avg", "min"], ["tx_amount"], ["customer_id"], ["1h", "7d", "28d", "90d"], exact_type=MONEY),
        RollingBlock(["max"], ["tx_amount"], ["terminal_id"], ["1h", "3d", "28d", "90d", "175d"]),
    ),
    created_timestamp=False,
)


def label_transactions(tx: DataFrame, labels: DataFrame) -> DataFrame:
    """Transactions with their label; NULL where there is none, one row per label where there are several.

    The event date travels along when the source carries it, so later filters still prune its partitions.
    """
    date = ["t.tx_date"] if "tx_date" in tx.columns else []
    return (
        tx.alias("t")
        .join(labels.alias("l"), F.col("t.tx_id") == F.col("l.tx_id"), "left")
        .select("t.tx_ts", "t.tx_id", "t.customer_id", "t.terminal_id", "t.tx_amount", "l.tx_fraud", *date)
    )


def build_features(
    staged: DataFrame,
    preset: Preset,
    strategy: str = "auto",
    keep: Column | None = None,
    created_at: Column | None = None,
    limits: Limits = Limits(),
) -> DataFrame:
    """All staged columns, the weekday, every feature of the preset, and the build time where the preset has one."""
    out = with_rolling(
        staged.select("*", weekday_name("tx_ts").alias("day_of_the_week")), preset.blocks, strategy, keep, limits
    )
    if not preset.created_timestamp:
        return out
    stamp = F.current_timestamp() if created_at is None else created_at
    return out.select("*", stamp.alias("created_timestamp"))
