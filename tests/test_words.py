from peopleflow.operators.words import distinct_words, top_words, word_count


def table(spark):
    rows = [(" San  Luis ", None), ("", "luis"), (None, None), ("tab\tand\nline", "San")]
    return spark.createDataFrame(rows, "a string, b string")


def test_counts_skip_blanks_and_nulls(spark):
    counts = {r.word: r.n for r in word_count(table(spark), ["a", "b"]).collect()}
    assert counts == {"san": 2, "luis": 2, "tab": 1, "and": 1, "line": 1}


def test_top_breaks_ties_by_word(spark):
    top = [(r.word, r.n) for r in top_words(table(spark), ["a", "b"], top=3).collect()]
    assert top == [("luis", 2), ("san", 2), ("and", 1)]


def test_distinct(spark):
    assert distinct_words(table(spark), ["a", "b"]).first().distinct_words == 5
