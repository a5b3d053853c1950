"""Number rules (apply everywhere).

* Money is summed as ``decimal(18,4)``: exact for inputs with up to four
  decimals, so the total does not depend on the order in which partitions
  are combined. The sum widens to ``decimal(28,4)``, which holds totals of
  trillions of lines without overflow. Results are returned as double.
* Means are the exact decimal sum (as double) divided by the count.
* Rounding to k decimals is half-to-even on the scaled value
  (``rint(x * 10^k) / 10^k``), the numpy rule the reference relies on.
* Integer casts truncate toward zero into bigint (no 2^31 overflow).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,4)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c) -> Column:
    """A money value as an exact decimal."""
    return _col(c).cast(MONEY)


def money_sum(c) -> Column:
    """Exact sum of money; NULL when every input is NULL."""
    return F.sum(money(c)).cast("double")


def money_mean(c) -> Column:
    """Mean of money: the exact decimal sum, as double, over the non-null count.

    Dividing in double (one correctly rounded IEEE division) makes the result
    bit-identical in every engine that sums exactly.
    """
    return money_sum(c) / F.count(_col(c))


def round_even(c, digits: int = 2) -> Column:
    """Half-to-even rounding on the scaled double (0.285 -> 0.28)."""
    scale = float(10 ** digits)
    return F.rint(_col(c) * F.lit(scale)) / F.lit(scale)


def round4(c) -> Column:
    """Final rounding of derived doubles, identical in Spark and DuckDB."""
    return round_even(c, 4)


def trunc_bigint(c) -> Column:
    """Truncate toward zero (2.9 -> 2, -2.9 -> -2)."""
    return _col(c).cast("bigint")


def currency_label(c) -> Column:
    """'$' followed by the truncated integer value."""
    return F.concat(F.lit("$"), trunc_bigint(c).cast("string"))
