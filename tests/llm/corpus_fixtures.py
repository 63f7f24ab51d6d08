import random

import pytest

from lakejobs.llm.shipping import ship

WORDS = "stone river lamp quiet garden winter paper signal copper method window harbor".split()
OTHER = "eau rivière nuit près être forêt hiver fenêtre élan pâle côté mère".split()


def prose(seed, words=60, vocabulary=WORDS):
    rng = random.Random(seed)
    out = [rng.choice(vocabulary) + str(rng.randint(0, 40)) * (rng.random() < 0.3)
           for _ in range(words)]
    return "".join(w + (".\n" if i % 11 == 10 else " ") for i, w in enumerate(out)).strip()


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def texts():
    """Null, empty, white, odd, copied, nearly copied and very long texts by id."""
    rows = {i: prose(i, 40 + i) for i in range(20)}
    near = prose(3, 400)
    rows |= {20: None, 21: "", 22: " \n\t ", 23: "x", 24: "two words", 25: rows[0], 26: rows[0],
             27: near, 28: near.replace("stone", "stones", 1), 29: "日本語 текст ñandú",
             30: prose(99, 30_000), 31: "1234 !!! ...", 32: "<|endoftext|> a<|x|>", 33: "a" * 70_000,
             34: prose(5, 50, OTHER), 35: "  double   spaced \n \n text  "}
    return rows


@pytest.fixture(scope="session")
def messy(spark, texts):
    """The same as documents, with repeated rows, null keys and columns of clashing names."""
    rows = [(i, t, ["en", "fr", None][i % 3 if i != 34 else 1], ["b", "a", None][i % 3], -1, "n")
            for i, t in texts.items()]
    rows += [rows[5], (None, "no id here at all", None, "b", -1, "n")]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, size int, cls string"
    ).repartition(3)


@pytest.fixture(scope="session")
def nothing(messy):
    return messy.where("1 = 0")
