"""Counts of the derived log that are known beforehand."""

import pytest

from earshot import Star
from earshot.plans import analyses
from earshot.sources.retail import from_retail

KNOWN = {
    "sf0.001": (1003, 3, 1000, 965, 35, 6, 12, 10, 8, 5, 1, 436),
    "sf0.01": (10021, 21, 10000, 9636, 364, 51, 121, 92, 80, 48, 12, 4705),
    "sf0.1": (100201, 235, 99966, 96389, 3577, 508, 1173, 918, 762, 474, 116, 46737),
}


@pytest.mark.parametrize("sf", KNOWN)
def test_summary(spark, sf):
    star = Star(from_retail(spark, f"/root/testdata/{sf}"))
    found = [r["value"] for r in analyses.data_quality_summary(star).collect()]
    assert tuple(found) == KNOWN[sf]
    raw, duplicates, staged, valid, rejected, *reasons, _ = found
    assert raw == duplicates + staged and staged == valid + rejected and sum(reasons) >= rejected
