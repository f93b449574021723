import random
import re

import pytest
from pyspark.sql import functions as F

from cofre.llm import common, decontamination

ITEM = "A train leaves Boston at 9:30 and covers 120 km in 2 hours before Maria boards the slow bus to Denver"
OTHER = "A train leaves Madrid at 7:15 and covers 300 km in 5 hours before Peter boards the slow bus to Lisbon"
#: One slot value of the item, Boston, would stand for two values.
TWICE = "We asked Anna whether the tall Anna sings better than the old Anna does on rainy days with her choir"
TWO = "We asked Anna whether the tall Mary sings better than the old Lucy does on rainy days with her choir"


def found(spark, documents, rows, items, **settings):
    benchmark = spark.createDataFrame([i + ("x", 1) for i in items], "item_id long, text string, `key` string, n long")
    hits = decontamination.contaminations(documents(rows, clashing=True), benchmark, **settings)
    return {(r.key, r.item) for r in hits.collect()}


def test_templates_and_slots(spark, documents):
    rows = [
        (1, ITEM), (2, f"Some words first. {OTHER}. And more after it."), (3, ITEM.upper()), (4, "A train leaves"), (5, None), (6, ""),
        (7, TWO), (8, TWICE), (None, ITEM), (9, ITEM), (9, ITEM), (10, "said... " + ITEM.replace(" ", " \n\t")),
        (11, "word " * 30_000 + OTHER), (12, "Unrelated text about gardens, written by nobody at all in the year of rain"),
    ]
    items = [(1, ITEM), (2, TWICE), (3, None), (4, ""), (5, "Two words"), (6, "one short question about rivers")]
    wanted = {(1, 1), (2, 1), (8, 2), (None, 1), (9, 1), (10, 1), (11, 1)}
    got = found(spark, documents, rows, items)
    assert got - {(3, 1)} == wanted  # upper case hides what is a name


def test_short_items_are_one_window(spark, documents):
    rows = [(1, "he asked one short question about rivers and left"), (2, "one short question about lakes")]
    assert found(spark, documents, rows, [(6, "One short question about rivers")]) == {(1, 6)}


def test_part_of_an_item(spark, documents):
    words = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)]
    rows = [(1, " ".join(words[:20])), (2, " ".join(words[:9])), (3, " ".join(words[30:]))]
    assert found(spark, documents, rows, [(1, " ".join(words))]) == {(1, 1), (3, 1)}


def long_item(one, two):
    words = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(59)]
    words[20], words[40] = one, two
    return " ".join(words)


def test_windows_against_the_rest_are_left_out_alone(spark, documents):
    rows = [(1, long_item("Anna", "Berta")), (2, long_item("4", "4")), (3, long_item("Berta", "Berta"))]
    assert found(spark, documents, rows, [(1, long_item("Anna", "Anna"))]) == {(1, 1), (2, 1), (3, 1)}
    assert found(spark, documents, rows, [(1, long_item("5", "7"))]) == {(1, 1), (2, 1), (3, 1)}


def test_two_numbers_that_become_one(spark, documents):
    item = "If there are 5 apples and 7 pears, how many are there?"
    rows = [(1, item.replace("5", "4").replace("7", "4")), (2, item.replace("5", "9")), (3, "If there are 4 apples in the house")]
    assert found(spark, documents, rows, [(1, item)]) == {(1, 1), (2, 1)}
    item = "If there are 5 apples and 5 pears, how many are there?"
    assert found(spark, documents, [(1, item.replace("5 p", "6 p"))], [(1, item)]) == set()


def test_windows_of_few_plain_words(spark, documents):
    item = "What is 12 x 7 + 5?"
    rows = [
        (1, item), (2, f"Please see here {item} And so on"), (3, "What is 13 x 7 + 5?"), (4, "What is it? 12 x 7 + 5"),
        (5, "Pray tell. What is 12 x 7 + 5? I do not know"),
    ]
    assert found(spark, documents, rows, [(1, item)]) == {(1, 1), (2, 1), (5, 1)}


def test_dense_windows_beside_a_template(spark, documents):
    item = "Add all of the numbers in this list " + " ".join(str(100 + i) for i in range(20))
    rows = [
        (1, "Add all of the numbers in this list " + " ".join(str(300 + i) for i in range(20))),
        (2, "Some list " + " ".join(str(300 + i) for i in range(20))), (3, " ".join(str(100 + i) for i in range(20))),
    ]
    assert found(spark, documents, rows, [(1, item)]) == {(1, 1), (3, 1)}


def test_first_word_after_an_unpunctuated_line(spark, documents):
    item = "What is the capital of France?"
    rows = [(1, f"Questions we see here {item}"), (2, "Questions\n" + item), (3, "we know that Paris is the capital of France"), (4, "What is the capital of Spain")]
    assert found(spark, documents, rows, [(1, item)]) == {(1, 1), (2, 1), (4, 1)}


def test_rows_stay_as_they_were(spark, documents):
    df = documents([(1, f"x {ITEM}"), (2, "clean words"), (2, "clean words"), (None, None), (None, ITEM)], clashing=True)
    items = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    stay = decontamination.drop_contaminated(df, items)
    assert stay.columns == df.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in stay.collect()) == [(0, ""), (2, "clean words"), (2, "clean words")]


@pytest.mark.parametrize("empty", ["documents", "items"])
def test_empty_tables(spark, documents, empty):
    rows, items = ([], [(1, ITEM)]) if empty == "documents" else ([(1, ITEM)], [])
    assert found(spark, documents, rows, items) == set()


def test_only_dataframe_operations(spark, documents):
    items = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    plan = decontamination.contaminations(documents([(1, ITEM)]), items)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_common_words_are_no_item(spark, documents):
    rows = [(1, "the cat and the dog"), (2, "Nothing of that"), (3, "What is 12 x 7 + 5? The answer")]
    assert found(spark, documents, rows, [(1, "the"), (2, "The cat"), (3, "What is 12 x 7 + 5?")]) == {(3, 3)}


def plain_templates(text):
    """Template windows once more, with plain loops; for texts without names at a beginning."""
    words = []
    for word in re.findall(r"[^\W_]+", text):
        if word.isdigit():
            words.append(("#", word))
        elif word[0].isupper() and words:
            words.append(("N", word.lower()))
        else:
            words.append((word.lower(), word.lower()))
    return words


def plain_matches(doc, item, window=8, coverage=0.5, enough=6):
    a, b = plain_templates(doc), plain_templates(item)
    n_windows = max(len(b) - window + 1, 1)
    covered, longest = set(), 0
    for diagonal in range(-len(b), len(a)):
        places = [
            p for p in range(n_windows)
            if 0 <= p + diagonal and p + diagonal + min(window, len(b)) <= len(a)
            and all(a[p + diagonal + i][0] == b[p + i][0] for i in range(min(window, len(b))))
        ]
        pairs = {(b[p + i][1], a[p + diagonal + i][1]) for p in places for i in range(min(window, len(b))) if b[p + i][0] in "#N"}
        values = {}
        for one, other in pairs:
            values.setdefault(one, set()).add(other)
        if any(len(v) > 1 for v in values.values()):
            places = []
        covered |= set(places)
        longest = max(longest, len(places))
    return len(covered) >= -(-n_windows * coverage // 1) or longest >= enough


def test_against_plain_templates(spark, documents):
    """Random questions with other numbers and names in random texts."""
    pick = random.Random(2)
    plain = [f"word{a}{b}" for a in "abcd" for b in "efgh"]
    people = ["Anna", "Berta", "Carla", "Dora"]

    def question():
        said = [pick.choice(plain) for _ in range(pick.randint(10, 16))]
        places = pick.sample(range(1, len(said)), 3)
        return [("P" if i == places[0] else "#") if i in places else w for i, w in enumerate(said)]

    def spoken(words):
        return " ".join(pick.choice(people) if w == "P" else str(pick.randint(10, 99)) if w == "#" else w for w in words)

    questions = [question() for _ in range(6)]
    items = [(i, spoken(q)) for i, q in enumerate(questions)]
    rows = []
    for i in range(60):
        q = list(pick.choice(questions))
        for _ in range(pick.choice([0, 0, 1, 4])):
            q[pick.randrange(len(q))] = pick.choice(plain)
        rows.append((i, " ".join(pick.choice(plain) for _ in range(6)) + " " + spoken(q) + " " + " ".join(pick.choice(plain) for _ in range(5))))
    wanted = {(k, i) for k, text in rows for i, item in items if plain_matches(text, item)}
    assert wanted and found(spark, documents, rows, items) == wanted


def test_long_lists_of_items_are_filtered_first(spark, documents, monkeypatch):
    rows = [(i, f"{ITEM} and {i}") if i % 3 == 0 else (i, "word " * 30 + str(i)) for i in range(30)]
    few = found(spark, documents, rows, [(1, ITEM)])
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    assert found(spark, documents, rows, [(1, ITEM)]) == few == {(i, 1) for i in range(0, 30, 3)}


def test_windows_of_all_sizes_have_the_marks_of_the_items(spark):
    texts = [ITEM, TWICE, "what is 12 x 7 + 5 now?", "What is 12 x 7", "5 kg, 6 kg, 7 kg and 8", "one short question about rivers", "COVID-19 in a text of X-5 words"]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    known = decontamination.item_windows(items, "text", "item_id", 8, 4).where("not named")
    wanted = {(r["item"], r["size"], r["place"], r["mark"]) for r in known.collect()}
    sizes = sorted({size for _, size, _, _ in wanted})
    lines = items.select(F.col("item_id").alias("key"), F.xxhash64("text").alias("row_hash"), decontamination.slotted(F.col("text")).alias("line"))
    windows = decontamination.text_windows(lines, sizes, 4).collect()
    assert {(r["key"], r["size"], r["at"], r["mark"]) for r in windows} >= wanted and sizes == [5, 7, 8]
    lengths = {r["key"]: len(r["line"].split(" ")) for r in lines.collect()}
    assert len(windows) == sum(max(n - size + 1, 0) for n in lengths.values() for size in sizes)


def test_a_text_is_levelled_once_and_windows_are_cut_by_generated_code(spark, documents):
    df = documents([(1, ITEM)])
    lines = df.select(F.col("doc_id").alias("key"), F.xxhash64("text").alias("row_hash"), decontamination.slotted(F.col("text")).alias("line"))
    plan = decontamination.text_windows(lines, [5, 8], 4)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("lambdafunction") == plan.count("lower(") == 1
    assert re.search(r"\*\(\d+\) Project [^\n]*xxhash64\(window", plan)
