"""Near copies under repeated and null ids."""

import corpus_pipeline

WORDS = [f"w{i}" for i in range(60)]
ONE, NEAR, OTHER = " ".join(WORDS), " ".join([*WORDS[:-1], "x"]), " ".join(f"o{i}" for i in range(60))


def kept(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return sorted(map(tuple, corpus_pipeline.without_near_copies(spark, docs, "").collect()), key=str)


def test_a_near_copy_does_not_stay_beside_a_head_of_its_id(spark):
    assert kept(spark, [(1, ONE), (2, NEAR), (2, OTHER)]) == [(1, ONE), (2, OTHER)]


def test_near_copies_of_one_id_and_of_no_id(spark):
    found = kept(spark, [(3, ONE), (3, NEAR), (None, OTHER), (None, OTHER + " y"), (None, OTHER + " z"), (4, "alone"), (4, "alone")])
    assert [i for i, _ in found] == [3, 4, None]


def test_a_null_id_gives_way_and_rows_without_words_stay(spark):
    assert kept(spark, [(None, ONE), (5, NEAR), (6, None), (6, None), (6, ""), (None, " ")]) == sorted(
        [(5, NEAR), (6, None), (6, None), (6, ""), (None, " ")], key=str
    )


def test_ids_of_their_own(spark):
    assert kept(spark, [(2, ONE), (1, NEAR), (3, OTHER), (4, None), (5, "")]) == sorted([(1, NEAR), (3, OTHER), (4, None), (5, "")], key=str)
