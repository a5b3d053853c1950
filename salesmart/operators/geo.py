"""Sales by state with a state-code lookup (A10 + J1).

The reference pairs codes with states by row position after sorting by
name, which shifts every later code as soon as one state is missing from
the data or the list. Here codes are attached by a left join on the state
name: unmatched states get a NULL code. The lookup is a small literal (or
derived) table, which Spark broadcasts where its size allows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.operators.marts import group_sum

# The reference's state list and codes, in its order
# (49 entries: Hawaii is present, Alaska and District of Columbia are not).
US_STATES = [
    "Alabama", "Arizona", "Arkansas", "California", "Colorado", "Connecticut", "Delaware",
    "Florida", "Georgia", "Hawaii", "Idaho", "Illinois", "Indiana", "Iowa", "Kansas",
    "Kentucky", "Louisiana", "Maine", "Maryland", "Massachusetts", "Michigan", "Minnesota",
    "Mississippi", "Missouri", "Montana", "Nebraska", "Nevada", "New Hampshire", "New Jersey",
    "New Mexico", "New York", "North Carolina", "North Dakota", "Ohio", "Oklahoma", "Oregon",
    "Pennsylvania", "Rhode Island", "South Carolina", "South Dakota", "Tennessee", "Texas",
    "Utah", "Vermont", "Virginia", "Washington", "West Virginia", "Wisconsin", "Wyoming",
]
US_STATE_CODES = [
    "AL", "AZ", "AR", "CA", "CO", "CT", "DE", "FL", "GA", "HI", "ID", "IL", "IN", "IA", "KS",
    "KY", "LA", "ME", "MD", "MA", "MI", "MN", "MS", "MO", "MT", "NE", "NV", "NH", "NJ", "NM",
    "NY", "NC", "ND", "OH", "OK", "OR", "PA", "RI", "SC", "SD", "TN", "TX", "UT", "VT", "VA",
    "WA", "WV", "WI", "WY",
]


def us_state_lookup(spark: SparkSession) -> DataFrame:
    """The literal (state, state_code) table."""
    rows = list(zip(US_STATES, US_STATE_CODES))
    return spark.createDataFrame(rows, "state string, state_code string")


def sales_by_state(sales: DataFrame, lookup: DataFrame) -> DataFrame:
    """Per-state sales with the state code joined by name, sorted by state."""
    g = group_sum(sales, ["state"])
    codes = lookup.select("state", "state_code")
    return (g.join(codes, "state", "left")
             .select("state", "state_code", "sales")
             .orderBy("state"))
