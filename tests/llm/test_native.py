"""Operators 3, 4, 6 and 7 against plain versions."""

import random
from collections import Counter, defaultdict

import pytest

from tallymill.llm import chat, decontamination, line_dedup, mixing, registry
from tests.conftest import SMALL, plan_of
from tests.llm import brute

NULLS = [(None, "a b c d e f", "x", None), (900, None, None, None), (901, "", "y", 1), (902, " \n\t ", "y", 1)]


def made_documents(seed=1, count=60):
    draw = random.Random(seed)
    words = [f"{a}{b}" for a in ("Wa", "ke", "lo", "Mi", "nu") for b in ("r", "s", "t", "é")]
    lines = [" ".join(draw.choices(words, k=draw.randint(1, 12))) for _ in range(40)]
    rows = []
    for key in range(count):
        first = draw.randrange(len(lines) - 6)
        text = [*lines[first : first + draw.randint(1, 6)], " ".join(draw.choices(words, k=draw.randint(0, 40)))]
        draw.random() < 0.5 and text.reverse()
        rows.append((key, "\n".join(text), draw.choice(["s1", "s2", "s3", None]), draw.randrange(9)))
    return rows, lines


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_lines long")


@pytest.mark.parametrize("most_sent", [1 << 14, 0])
def test_leaks_equal_brute_force_both_ways(spark, most_sent):
    rows, lines = made_documents()
    items = {at: "\n".join(lines[at : at + 3]) for at in range(0, 30, 3)} | {50: "two words", 51: "", 52: None, 53: lines[0]}
    rows += [(800, "TWO words", "s", 0), *NULLS[1:]]
    found = decontamination.leaks(frame(spark, rows), spark.createDataFrame(list(items.items()), "item_id long, text string"), most_sent=most_sent)
    assert {tuple(row) for row in found.collect()} == brute.leaks({row[0]: row[1] for row in rows}, items)


def test_leaks_of_nothing(spark):
    documents, items = frame(spark, []), spark.createDataFrame([], "item_id long, text string")
    assert decontamination.leaks(documents, items).count() == 0
    assert decontamination.leaks(frame(spark, NULLS), items).count() == 0


@pytest.mark.parametrize("most_sent", [0, 1 << 14])
def test_items_without_an_id_match_nothing(spark, most_sent):
    items = spark.createDataFrame([(None, "a b c d e f g"), (3, "h i j k l m n")], "item_id long, text string")
    documents = frame(spark, [(1, "a b c d e f g", "s", 0), (2, "h i j k l m n", "s", 0)])
    found = decontamination.leaks(documents, items, most_sent=most_sent)
    assert [tuple(row) for row in found.collect()] == [(2, 3, 3, 3)]


@pytest.mark.parametrize("most_sent", [0, 1 << 14])
@pytest.mark.parametrize("percent", [75, 100, 30])
def test_documents_at_the_edge_of_a_size_class(spark, most_sent, percent):
    """Items of 1 to 40 shingles and documents that hold the least part of them that counts, or one shingle less."""
    items, rows = {}, []
    for size in range(1, 41):
        words = [f"i{size}w{at}" for at in range(size + 4)]
        items[size] = " ".join(words)
        need = -(-size * percent // 100)
        for extra, key in ((0, size), (-1, 100 + size)):
            rows.append((key, " ".join(words[: need + extra + 4]) if need + extra else "none", "s", 0))
    found = decontamination.leaks(
        frame(spark, rows), spark.createDataFrame(list(items.items()), "item_id long, text string"), percent, most_sent
    )
    assert sorted((row.doc_id, row.item_id) for row in found.collect()) == [(size, size) for size in range(1, 41)]


def test_long_document_holds_a_short_item(spark):
    draw = random.Random(4)
    item = " ".join(str(draw.random()) for _ in range(20))
    filler = " ".join(str(draw.random()) for _ in range(40_000))
    documents = frame(spark, [(1, f"{filler} {item} {filler}", "s", 0), (2, filler, "s", 0), (1, f"{filler} {item} {filler}", "s", 0)])
    found = decontamination.leaks(documents, spark.createDataFrame([(7, item)], "item_id long, text string"))
    assert [tuple(row) for row in found.collect()] == [(1, 7, 16, 16)]


def test_lines_equal_brute_force(spark):
    rows, _ = made_documents(seed=2)
    rows += NULLS[1:] + [(903, "a\n" * 50, "s", 0), (904, "a\n" * 50, "s", 0)]
    expected = brute.without_lines({row[0]: row[1] for row in rows})
    found = line_dedup.line_deduplicated(frame(spark, rows))
    assert found.columns == ["doc_id", "text", "source", "n_lines", "n_removed"]
    assert {row.doc_id: (row.n_lines, row.n_removed, row.text) for row in found.collect()} == expected


def test_lines_of_repeated_rows_and_null_ids(spark):
    text = "one\ntwo\nthree"
    rows = [(5, text, "s", 0), (5, text, "s", 0), (None, text, "s", 0), (6, text, "s", 0)]
    found = line_dedup.line_deduplicated(frame(spark, rows)).select("doc_id", "n_removed").collect()
    assert Counter(map(tuple, found)) == Counter([(5, 3), (5, 3), (None, 0), (6, 3)])
    assert line_dedup.line_deduplicated(frame(spark, [])).count() == 0


def nodes(spark, rows):
    return spark.createDataFrame(rows, "tree long, node long, parent long, role string, text string, score double")


def test_branches_are_ranked_and_formatted(spark):
    rows = [
        (1, 1, None, "user", "hi", 0.0),
        (1, 2, 1, "assistant", "a", 1.0),
        (1, 3, 1, "assistant", "b", 3.0),
        (1, 4, 3, "user", "c", 1.0),
        (1, 5, 3, None, None, None),
        (2, 1, 9, "user", "lost parent", 0.0),
        (3, 1, 2, "user", "round", 0.0),
        (3, 2, 1, "user", "and round", 0.0),
        (3, 3, 2, "user", "hangs on it", 0.0),
    ]
    found = {(row.tree, row.leaf): row for row in chat.formatted(nodes(spark, rows)).collect()}
    assert {key: (row["rank"], row.n_turns) for key, row in found.items()} == {(1, 4): (1, 3), (1, 5): (2, 3), (1, 2): (3, 2), (2, 1): (1, 1)}
    assert found[1, 4].formatted == "### user\nhi</turn>\n### assistant\nb</turn>\n### user\nc</turn>\n"
    assert [found[1, 4].formatted[span.start : span.end] for span in found[1, 4].loss_spans] == ["b"]
    best = chat.formatted(nodes(spark, rows), best=1).collect()
    assert {(row.tree, row.leaf) for row in best} == {(1, 4), (2, 1)}
    assert chat.formatted(nodes(spark, [])).count() == 0


def test_marks_inside_texts_are_read_back(spark):
    draw = random.Random(3)
    pieces = ["### ", "</turn>\n", "\\", "\\b", "\\l", "\n", "é", "#", "<", "user", "🙂", "\\n"]
    rows = [
        (tree, turn, turn - 1 if turn else None, "".join(draw.choices(pieces, k=draw.randint(0, 3))), "".join(draw.choices(pieces, k=draw.randint(0, 6))), 0.0)
        for tree in range(40)
        for turn in range(draw.randint(1, 5))
    ]
    found = chat.formatted(nodes(spark, rows)).select("tree", chat.turns_of("formatted").alias("turns")).collect()
    expected = defaultdict(list)
    for tree, _, _, role, text, _ in rows:
        expected[tree].append((role, text))
    assert {row["tree"]: [tuple(turn) for turn in row.turns] for row in found} == expected


def test_deep_tree(spark):
    rows = [(1, node, node - 1 if node else None, "assistant", f"t{node}", 0.0) for node in range(300)]
    found = chat.formatted(nodes(spark, rows)).collect()
    assert [row.n_turns for row in found] == [300]
    assert [text for _, text in found[0].formatted and [(0, found[0].formatted[s.start : s.end]) for s in found[0].loss_spans]] == [f"t{n}" for n in range(300)]


def test_repeated_turn_numbers_are_turns(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, None, None), (None, 3, "assistant", "x")]
    chains = chat.chains(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    found = {row.tree: row.formatted for row in chat.formatted(chains).collect()}
    assert found == {
        1: "### \n</turn>\n### user\na</turn>\n### user\na</turn>\n### user\nb</turn>\n",
        None: "### assistant\nx</turn>\n",
    }


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 100, "b": 100, "c": 100},
        {"a": 10, "b": 10, "c": 1000, "d": 5, "e": 900, None: 3000},
        {"a": 1, "b": 1, "c": 100_000},
        {None: 7},
        {"a": 0, "b": 50},
        {f"s{at:02}": at * at for at in range(30)},
    ],
)
def test_targets_equal_sharing_by_rounds(spark, sizes):
    totals = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {row.source: row.target for row in mixing.targets(totals).collect()}
    assert found == pytest.approx(brute.shared_targets(sizes))


@pytest.mark.parametrize("seats", [0, 1, 7, 50, 1000])
def test_quotas_equal_highest_quotients(spark, seats):
    draw = random.Random(seats)
    claims = [(group, key, draw.choice([1.0, 2.0, draw.uniform(0, 900)]), seats) for group in range(3) for key in range(1, 9)]
    claims += [(9, 1, 0.0, seats), (9, 2, 5.0, seats)]
    quotas = mixing.apportioned(spark.createDataFrame(claims, "g long, key long, w double, seats long"), ["g"], "key", "w", "seats")
    found = defaultdict(dict)
    for row in quotas.collect():
        found[row.g][row.key] = row.quota
    for group in (0, 1, 2, 9):
        weights = {key: weight for g, key, weight, _ in claims if g == group}
        assert {k: v for k, v in found[group].items() if v} == brute.highest_quotients(weights, seats)


def test_mixture_meets_its_targets(spark):
    draw = random.Random(5)
    rows = [(key, "w " * draw.choice([0, 1, 30, 400, 900]), draw.choice(["a", "a", "a", "b", "c", None]), 0) for key in range(3000)]
    rows += NULLS
    found = mixing.mixed_sources(frame(spark, rows)).collect()
    assert len(found) == len(rows)
    sizes, taken, target = Counter(), Counter(), {}
    for row in found:
        assert 0 <= row.taken <= 3 * row["size"]
        sizes[row.source] += row["size"]
        taken[row.source] += row.taken
        target[row.source] = row.target
    assert target == pytest.approx(brute.shared_targets(sizes))
    for source in ("a", "b", "c", None):
        assert taken[source] == pytest.approx(target[source], rel=0.02)
    again = mixing.mixed_sources(frame(spark, rows).repartition(7)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, found))
    assert mixing.mixed_sources(frame(spark, [])).count() == 0


def test_conversations_with_clashing_columns(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "ho"), (2, None, None, None), (None, 0, "user", "x"), (None, 0, "user", "x")]
    plain = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    names = ("tree", "node", "parent", "score", "leaf", "distance", "t", "n", "up", "rank")
    clashing = plain.selectExpr("*", *(f"'{name}' AS {name}" for name in names))
    both = [Counter(map(tuple, chat.formatted(chat.chains(frame)).select("tree", "n_turns", "formatted").collect())) for frame in (plain, clashing)]
    assert both[0] == both[1] and len(both[0]) == 3
    nodes_of = lambda frame: chat.formatted(chat.chains(frame), best=1).select("tree", "formatted").collect()
    assert Counter(map(tuple, nodes_of(plain))) == Counter(map(tuple, nodes_of(clashing)))


@pytest.mark.parametrize("size", [1, 50, 130, 2000, 9000, 30_000])
@pytest.mark.parametrize("rank", [0, 1, 2])
def test_small_sources_come_near_their_targets(spark, size, rank):
    """A source of a few words beside large ones, with the highest, the middle and the lowest weight."""
    names = ["a", "b", "c"]
    draw, rows, key = random.Random(size), [], 0
    for at, name in enumerate(names):
        left = size if at == rank else 40_000
        while left:
            words = min(left, draw.choice([1, 3, 40, 700]))
            rows.append((key, "w " * words, name, 0))
            left, key = left - words, key + 1
    found = mixing.mixed_sources(frame(spark, rows)).collect()
    taken, target = Counter(), {}
    for row in found:
        assert 0 <= row.taken <= 3 * row["size"]
        taken[row.source] += row.taken
        target[row.source] = row.target
    assert target == pytest.approx(brute.shared_targets({name: size if at == rank else 40_000 for at, name in enumerate(names)}))
    for name in names:
        assert abs(taken[name] - target[name]) <= max(3, 0.015 * target[name])


def test_rows_with_one_id_are_taken_alike_again(spark):
    rows = [(key % 5, f"{key} " * 30, "a", at) for key in range(300) for at in range(2)] + [(1, "x " * 400, "b", 0)]
    found = [
        Counter(map(tuple, mixing.mixed_sources(frame(spark, rows).repartition(parts), keep=("text", "n_lines")).collect()))
        for parts in (1, 7)
    ]
    assert found[0] == found[1]


def test_native_operators_use_no_python(spark):
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    operators = (decontamination.leaks(documents, items), line_dedup.line_deduplicated(documents), mixing.mixed_sources(documents))
    for found in (*operators, registry.QUERIES["op6_chat_format"](spark, SMALL)):
        plan = plan_of(found)
        assert "Python" not in plan and "Arrow" not in plan and "ExistingRDD" not in plan
