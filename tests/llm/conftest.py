import pytest

from tablecheck.llm.common import ship

LONG = "wort " * 30_000 + "x" * 50_000
CLASHING = (
    "size slice key word row copy known id part place pivot vector component node u v task "
    "digest ids decoded likelihood host domain declared score label data kept_id text_key later"
).split()
TEXTS = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "a b c d e f g h"), (6, "a b c d e f g h"),
    (6, "a b c d e f g h"), (7, LONG), (8, "Été à la plage, déjà!"), (9, "中文字。 ▁ mark ▁▁"),
    (10, "it's don't <|endoftext|> 12.5%"), (None, "no id"), (None, None),
]


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def edges(spark):
    """Documents with nulls, copies, repeated rows, a very long text and clashing columns."""
    columns = ["doc_id long", "text string", "lang string", "source string", "n_chars long"]
    rows = [(i, t, None if n % 3 else "en", None if n % 2 else "src1", None)
            for n, (i, t) in enumerate(TEXTS)]
    extra = [f"{name} string" for name in CLASHING]
    rows = [(*row, *["x"] * len(extra)) for row in rows]
    return spark.createDataFrame(rows, ", ".join(columns + extra))


@pytest.fixture(scope="session")
def nothing(edges):
    return edges.where("false")
