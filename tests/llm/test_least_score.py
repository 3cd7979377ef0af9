"""The pipeline's language limit follows the number of languages."""

import corpus_pipeline


def test_limit_follows_the_number_of_languages():
    assert [round(corpus_pipeline.least_score(n), 4) for n in (1, 4, 40)] == [1.0, 0.3, 0.03]
