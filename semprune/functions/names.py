"""Names derived from numbers: keep fractions and subset labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fraction_suffix(fraction: float) -> str:
    """``0.8`` -> ``0pt8``, usable in column and file names."""
    return str(float(fraction)).replace(".", "pt")


def keep_name(fraction: float) -> str:
    return f"keep_{fraction_suffix(fraction)}"


def kept_set_name(fraction: float) -> str:
    return f"similarities_{fraction_suffix(fraction)}"


def subset_label(subset: Column, n_subsets: int) -> Column:
    """Subset number padded with zeros to the width of the number of subsets."""
    return F.lpad(subset.cast("string"), len(str(n_subsets)), "0")
