import pytest

from samples import prose


@pytest.fixture(scope="session")
def odd_rows():
    passage = prose(1, 70)
    rows = [(i, prose(100 + i), f"s{i % 3}") for i in range(20)]
    rows += [(30, None, "s0"), (31, "", None), (32, " \n\t ", "s1"), (None, prose(5), "s1"), (33, "one", "s2")]
    rows += [(34, prose(6), None), (34, prose(6), None), (34, prose(7), "s0")]  # repeated row and repeated id
    rows += [(40, prose(8, 20_000), "s0"), (41, "word " * 3000, "s0"), (42, "x" * 100_000, "s1")]
    rows += [(50, prose(9) + "\n" + passage, "s1"), (51, prose(10) + "\n" + passage + " tail words here.", "s2")]
    rows += [(60, prose(11), "s1"), (61, prose(11), "s1"), (62, prose(11) + " More.", "s2")]
    return rows
