import math
from collections import Counter

from linkquality.llm.toxicity import MISSPELLED, QUOTED, REINFORCED, ToxicityModel


def test_counts_of_a_term_are_summed_over_kinds():
    model = ToxicityModel({"moron": 2.0, "idiot": 1.0}, frozenset({"moron"}), [0.0] * 6)
    kinds = [(("moron", 0), 50), (("moron", REINFORCED), 1), (("moron", QUOTED), 3),
             (("moron", QUOTED | REINFORCED | MISSPELLED), 4), (("moron", MISSPELLED), 2),
             (("moron", MISSPELLED | REINFORCED), 5), (("idiot", 0), 1), (("idiot", MISSPELLED), 9)]
    want = [1.0, 2 * math.log1p(51) + math.log1p(1), 2 * math.log1p(7), 2 * math.log1p(7), 2.0,
            math.log1p(100 * 59 / 1000)]
    for order in (kinds, kinds[::-1]):
        got = model.features(Counter(dict(order)), 1000)
        assert all(math.isclose(a, b) for a, b in zip(got, want)) and len(got) == len(want)
    assert model.features(Counter(dict(kinds)), 1000) == model.features(Counter(dict(kinds[::-1])), 1000)
