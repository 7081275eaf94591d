import re

import __spark_entry__ as driver


def test_each_operator_and_the_pipeline_have_a_query():
    names = set(driver.queries())
    assert {int(m[1]) for n in names if (m := re.match(r"op(\d+)_", n))} == set(range(1, 14))
    assert "pipeline" in names and len(driver.corpus_pipeline.STAGES) == 5
