import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import pytest


@pytest.fixture()
def llm_scratch(spark):
    from lakestrata.llm.tables import Scratch, ship_code

    ship_code(spark)
    return lambda tag="test": Scratch(spark, tag)
