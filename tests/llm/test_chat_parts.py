from linkquality.llm.chat import perspectives
from tests.llm.test_url_chat import render


def test_parts_are_cut_by_message_number(spark):
    """One dialogue of 9,000 messages on eight turn numbers beside small ones."""
    hot = [(7, i % 8, ("ann", "bob", "system")[i % 3], f"m{i * 7919 % 9000}") for i in range(9000)]
    rest = [(8, 1000, "ann", "far"), (8, 3, "bob", "near")] + [(9, 0, "ann", "same")] * 5000
    df = spark.createDataFrame(hot + rest, "conv_id long, turn long, role string, text string").repartition(7)
    got = perspectives(df).collect()
    assert max(r.n_messages for r in got) <= 256
    for me in ("ann", "bob"):
        parts = sorted((r for r in got if r.conv_id == 7 and r.perspective == me), key=lambda r: r.part)
        assert [r.part for r in parts] == list(range(36))          # 9,000 / 256
        full = sorted({(t, w, x) for _, t, w, x in hot})
        assert "".join(r.rendered for r in parts) == render(full, me)[0]
        assert (parts[1].rendered, parts[1].mask) == render(full[256:512], me)
        assert sum(r.n_trained for r in parts) == sum(w == me for _, w, _ in full)
    assert {(r.conv_id, r.part, r.n_messages) for r in got if r.conv_id != 7} == {(8, 0, 2), (9, 0, 1)}
