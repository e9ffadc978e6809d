"""What a reused Python worker keeps from other steps goes when a lean step begins."""

from tickmill.llm import bpe, common


def test_lean_step_drops_what_others_keep():
    bpe._codecs[1] = "a codec and its cache"
    assert list(common.lean(lambda batches: (b * 2 for b in batches))(iter([1, 2]))) == [2, 4]
    assert not bpe._codecs
