from isohyet.llm import quality_rules as Q

CLEAN = "\n".join(" ".join(f"word{i}x{j}" for j in range(12)) + "." for i in range(6))


def _judged(spark, rows, schema="doc_id long, text string"):
    return {r.doc_id: r for r in Q.judge(spark.createDataFrame(rows, schema)).collect()}


def test_edge_cases(spark):
    got = _judged(spark, [(1, None), (2, ""), (3, " \n\t "), (4, CLEAN), (None, CLEAN)])
    for k in (1, 2, 3):
        assert not got[k].kept and got[k].base_failed and got[k].n_words == 0 and got[k].n_repeat_words == 0
    assert got[4].kept and got[4].n_words == 72 and got[4].n_bad_lines == 0 and got[None].kept


def test_repeated_windows_count_each_word_once(spark):
    text = "a b c d a b c e"  # "a b c" twice: six words
    assert _judged(spark, [(1, text), (2, "x x x x x"), (3, "a b")])[1].n_repeat_words == 6
    got = _judged(spark, [(1, text), (2, "x x x x x"), (3, "a b")])
    assert got[2].n_repeat_words == 5 and got[3].n_repeat_words == 0


def test_lines_fail_on_their_own(spark):
    nav = "Home | News | Sport | About | More"
    junk = "A!! B!! C!!"
    got = _judged(spark, [(1, CLEAN + "\n" + nav + "\n" + junk), (2, CLEAN.splitlines()[0] + "\n" + "\n".join([nav] * 20))])
    assert got[1].kept and got[1].n_bad_lines == 2 and got[1].clean_text == CLEAN
    assert not got[2].kept and got[2].n_dup_lines == 19


def test_keep_clean_returns_the_columns_of_its_input(spark):
    df = spark.createDataFrame([(1, CLEAN + "\n| | |", "en", 5, "mine"), (2, "short", "en", 5, "x"), (3, CLEAN + "\n", "en", 7, "y")],
                               "doc_id long, text string, lang string, n_chars long, kept string")
    out = Q.keep_clean(df)
    assert out.schema.simpleString() == df.schema.simpleString()
    got = {r.doc_id: r for r in out.collect()}
    assert set(got) == {1, 3}
    assert got[1].text == CLEAN and got[1].n_chars == len(CLEAN) and got[1].kept == "mine"
    assert got[3].text == CLEAN + "\n" and got[3].n_chars == 7  # nothing to remove: as it was
    assert Q.keep_clean(df.limit(0)).count() == 0
