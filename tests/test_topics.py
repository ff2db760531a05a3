import numpy as np

from murmurate.operators import topics
from murmurate.plans.pipeline import PipelineConfig, _parser


def test_topics_are_fitted_on_every_message(spark):
    themes = ["wireless network driver", "apt package update", "music sound player", "music sound volume"]
    # Themes of different size, as equal ones leave the order of topics to rounding.
    rows = [(i, f"{themes[(0, 1, 0, 2, 0, 1, 0, 3, 1, 0)[i % 10]]} pair{i // 2}") for i in range(2100)]
    m = topics.fit_topics_on(spark.createDataFrame(rows, "message_id int, text_cleaned string"), topics=3)
    assert m.fit_rows == 2100 and {f"pair{i}" for i in range(1050)} <= set(m.vocabulary)
    # The table and the list give one model.
    local = topics.fit_topics([t for _, t in rows], topics=3)
    assert m.vocabulary == local.vocabulary and m.rounds == local.rounds < 400
    assert np.allclose(m.topics, local.topics, atol=1e-6)
    assert topics.fit_topics_on(spark.createDataFrame(rows, "message_id int, text_cleaned string"), topics=3, sample=500).fit_rows == 500


def test_weights_are_the_best_ones():
    m = topics.fit_topics(["a1 b1 b1 c1", "b1 c1 d1", "a1 d1 d1 e1", "e1 a1", "c1 e1 b1"], topics=2)
    x = m.matrix(["a1 b1 e1", "", "d1 d1 c1"])
    w, gram, top = m.weights(x), m.topics @ m.topics.T, x.times(m.topics.T)
    slope = w @ gram - top
    assert (w >= 0).all() and (slope > -1e-5).all() and (np.abs(slope[w > 0]) < 1e-5).all()
    assert np.diff(x.starts).tolist() == [3, 0, 2] and w[1].tolist() == [0, 0]


def test_topic_sizes_can_be_chosen():
    c = PipelineConfig()
    assert (c.topic_sample, c.topic_features, c.topic_rounds) == (None, 20_000, 400)
    a = _parser().parse_args(["silver", "--lexicon", "x", "--topics", "--topic-sample", "9", "--topic-features", "8", "--topic-rounds", "7", "--topic-count", "6"])
    assert (a.topic_sample, a.topic_features, a.topic_rounds, a.topic_count) == (9, 8, 7, 6)
