from rolefeed.llm import decontaminate


def found(spark, items, docs):
    frame = lambda texts, name: spark.createDataFrame(list(enumerate(texts)), f"{name} long, text string")
    return {(r.doc_id, r.item_id): r.coverage for r in decontaminate.leaks(frame(docs, "doc_id"), frame(items, "item_id")).collect()}


def test_numbers_and_units_may_collide_and_diverge(spark):
    items = ["A train travels 60 miles in 2 hours from Boston. How many miles does it travel in 5 hours then?",
             "Each box of 4 pens costs 4 dollars, so how much will a box of 9 pens cost here?"]
    docs = ["A train travels 70 km in 3 hours from Leeds. How many km does it travel in 3 hours then?",
            "A train travels 70 km in 3 hours from Leeds. How many miles does it travel in 8 days then?",
            "Each box of 6 pens costs 7 euros, so how much will a box of 7 pens cost here?",
            "Each bag of 6 nuts weighs 7 grams, so how heavy can one bag of 7 nuts be there?"]
    assert found(spark, items, docs) == {(0, 0): 1, (1, 0): 1, (2, 1): 1}


def test_names_that_begin_sentences(spark):
    items = ["Anna picks 5 ripe pears while Bert sleeps. Anna then gives 2 ripe pears to Bert and Anna eats 1 more."]
    docs = ["Carl picks 7 ripe pears while Dora sleeps. Carl then gives 3 ripe pears to Dora and Carl eats 3 more.",
            "Carl picks 7 ripe pears while Dora sleeps. Emil then gives 3 ripe pears to Fred and Fred eats 3 more.",
            "Old tales. ANNA PICKS 5 RIPE PEARS WHILE BERT SLEEPS. Anna then gives 9 ripe pears to Kurt and Anna eats 8 more."]
    got = found(spark, items, docs)
    assert set(got) == {(0, 0), (2, 0)} and got[0, 0] == 1


def test_a_capital_word_in_lower_case_elsewhere_stays_literal():
    words = decontaminate.canonical(["The sea. He read The Sea and the rest. Anna slept, as Anna does. Once.", "Anna slept"])
    begins = [words.tokens[p] for p, a, b in zip(words.place.tolist(), words.kind.tolist(), words.named.tolist()) if a != b]
    assert begins == ["Anna"]
