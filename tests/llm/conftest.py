import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture
def hard(spark):
    """documents-like rows with every awkward case; hard([]) is the empty table."""
    import hard as rows
    from rollcall.session import tune

    tune(spark)
    return lambda given=None: rows.frame(spark, given)
