"""Exclamation marks end words and stand for letters only inside them."""

from loomframe.llm.codepoints import fold
from loomframe.llm.toxicity import ToxicLexicon, with_seeds


def test_exclamation_marks_end_words():
    assert fold("L0S3R!!") == " ioser " and fold("sh!t id!!ot $hit tr4sh hey!") == " shit idiiot shit trash hey "
    assert fold("!") == fold("!!") == " " and fold("x!​y") == " xiy "
    lexicon = ToxicLexicon(with_seeds(), ())
    assert all(lexicon.strength(t) == lexicon.strength("idiot") > 0 for t in ("idiot!", "loser!!", "L0S3R!!", "you idiot!"[4:]))
