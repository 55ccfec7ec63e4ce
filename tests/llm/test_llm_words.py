"""Words of ASCII texts are cut by a pattern of their own."""

import random
import re

import regex

from lexflume.llm import bpe


def test_ascii_pattern_cuts_like_the_general_one():
    rng = random.Random(4)
    letters = [chr(i) for i in range(128)] + list("  \n\t''aAzZ09stremdlv") * 6
    plain, general = re.compile(bpe.SPLIT_ASCII), regex.compile(bpe.SPLIT)
    for _ in range(20_000):
        text = "".join(rng.choices(letters, k=rng.randrange(24)))
        assert plain.findall(text) == general.findall(text), text
