"""Rule backend (R1-R14), model backend through mapInPandas, prompts, LM rows."""

from pyspark.sql import functions as F

from tidewrack.operators import infer as INF
from tidewrack.operators import lm as LM
from tidewrack.operators import prompts as PR
from tidewrack.operators.joins import small_side


def norm(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k long, raw_text string")
    return [r.clean_text for r in INF.normalise(df).orderBy("k").collect()]


def test_normaliser_golden_cases(spark):
    # Input and output of the two cases.
    got = norm(spark, ["The Blue Monster at Trump National Doral. http://fb.me/1mtpR0yqs",
                       "Trump Towers, Istanbul, Sisli will be one of the country’s top landmarks http://bit.ly/UD6fK0"])
    assert got == ["The Blue Monster at Trump National Doral.",
                   "Trump Towers, Istanbul, Sisli will be one of the country’s top landmarks."]


def test_rule_cases(spark):
    got = norm(spark, [
        "@GinaCHaley They devalue everything, stupid!",
        "BREAKING: big news http://x.co/a",
        "RT @SunnyNguyen: vote for Trump! #MAGA #news",
        '"Give me a smart idiot over a stupid genius any day." - Samuel Goldwyn',
        "Tonight @ 9pm w/ #MakeItGreat -- see @FoxNews !!!",
        "   ",
    ])
    assert got == [
        "Gina C. Haley, They devalue everything, stupid!",
        "big news.",
        "vote for me! MAGA.",
        "Give me a smart idiot over a stupid genius any day.",
        "Tonight at 9pm with make it great. see Fox News!!!",
        "",
    ]


def test_model_backend_runs_per_worker(spark):
    def factory():
        return lambda prompts: ["`" + p.rsplit("RAW TEXT:\n`", 1)[1].split("`", 1)[0].upper() + "`" for p in prompts]

    df = spark.createDataFrame([("1", "hello"), ("2", "  ")], "id string, raw_text string")
    out = {r.id: r.clean_text for r in INF.normalise(df, backend=INF.ModelBackend(factory)).collect()}
    assert out == {"1": "HELLO", "2": ""}


def test_model_is_built_once_per_worker(spark, tmp_path):
    def factory():
        import os
        import uuid
        (tmp_path / f"{os.getpid()}-{uuid.uuid4().hex}").touch()
        return lambda prompts: ["x"] * len(prompts)

    backend = INF.ModelBackend(factory)
    df = spark.range(0, 400, 1, 40).selectExpr("CAST(id AS STRING) AS id", "concat('t', id) AS raw_text")
    for _ in range(2):
        assert INF.normalise(df, backend=backend).count() == 400
        INF.normalise(df, backend=backend).collect()
    built = [p.name.split("-")[0] for p in tmp_path.iterdir()]
    assert built and len(built) == len(set(built))  # 40 tasks a run, one model per process
    assert INF.ModelBackend(factory).key != backend.key


RULE_CASES = [  # rule, input, output; traced by hand from the rule list
    ("R1", "two\n\n lines", "two lines."), ("R2", "ICYMI – read this", "read this."), ("R2", "FLASHBACK: then", "then."),
    ("R3", "go ftp://a.b/c now", "go now."), ("R4", "RT @Some_One: Donald Trump's plan, says Trump", "my plan, says me."),
    ("R5", '"We won" via @FoxNews', "We won."), ("R6", "@J_R_Smith hello", "J. R. Smith, hello."), ("R7", "ask @J_R_Smith now", "ask J. R. Smith now."),
    ("R8", "so #CamelTag and #MAGA #update", "so camel tag and MAGA."), ("R9", "Big day — Donald J. Trump", "Big day."), ("R9", "Enjoy via @realDonaldTrump", "Enjoy."),
    ("R10", "a,b,c", "a, b, c."), ("R10", "Great!!! Yes??", "Great!!! Yes??"), ("R10", "w/ us - now", "with us. now."), ("R11", '"All of it"', "All of it."),
    ("R12", "USA Today", "USA Today."), ("R14", "No end", "No end."), ("R14", "An end!", "An end!"),
]


def test_each_rule_by_hand(spark):
    got = norm(spark, [t for _, t, _ in RULE_CASES])
    assert [(r, g) for (r, _, _), g in zip(RULE_CASES, got, strict=True)] == [(r, w) for r, _, w in RULE_CASES]


def test_prompt_layout(spark):
    cfg = PR.PromptConfig("R", "T", ("a", "b"), (("in1", "out1"), ("in2", "out2")))
    posts = spark.createDataFrame([("in2",)], "raw_text string")
    block = PR.instruction_block(cfg, posts).first()
    want = "R\n\nT You MUST follow these rules:\n1. a\n2. b\n\nHere are some examples:" \
           "\n\nRAW TEXT:\n`in2`\nNORMALIZED TEXT:\n`out2`\n"
    assert block.block == want and block.n_examples == 1
    p = spark.createDataFrame([("x",)], "raw_text string")
    prompt = PR.with_prompts(p, spark.createDataFrame([(want,)], "block string")).first().prompt
    lines = want.split("\n") + ["---", PR.CLOSING_LINES[1], "RAW TEXT:\n`x`", "NORMALIZED TEXT:\n`"]
    assert prompt == "\n".join(lines)


def test_fixed_length(spark):
    df = spark.createDataFrame([([5, 6, 7],), (list(range(1, 9)),)], "input_ids array<bigint>")
    padded, mask = LM.fixed_length(F.col("input_ids"), 5)
    rows = df.select(padded.alias("i"), mask.alias("m")).collect()
    assert (rows[0].i, rows[0].m) == ([5, 6, 7, 0, 0], [1, 1, 1, 0, 0])
    assert (rows[1].i, rows[1].m) == ([1, 2, 3, 4, 5], [1, 1, 1, 1, 1])


def test_vocabulary_reserves_pad(spark):
    df = spark.createDataFrame([("b a a",), ("c",)], "text string")
    v = {r.token: (r.id, r["count"]) for r in LM.vocabulary(df).collect()}
    assert v == {"[PAD]": (0, 0), "[UNK]": (1, 0), "a": (2, 2), "b": (3, 1), "c": (4, 1)}


def test_encode_joins_words_of_packs_not_tokens(spark, monkeypatch):
    texts = [("a", "x y x. " * 500), ("b", None), ("c", ""), ("d", "Y new x"), (None, "y"), ("d", "x x")]
    df = spark.createDataFrame(texts, "k string, text string").coalesce(1)
    vocab = LM.vocabulary(df.where("k <> 'd'"))
    ids = {r.token: r.id for r in vocab.collect()}
    tok = lambda t: (t or "").lower().replace(".", " .").split()
    for length, small in ((None, 64_000_000), (2, 0)):
        monkeypatch.setattr(LM, "small_side", lambda v, n=small: small_side(v, n))
        rows = [(r.k, r.input_ids) for r in LM.encode(df, vocab, "k", length=length).collect()]
        assert sorted(rows, key=str) == sorted(((k, [ids.get(w, 1) for w in tok(t)][:length]) for k, t in texts), key=str)
    many = spark.createDataFrame([(i, "x y z") for i in range(2500)], "k int, text string").coalesce(1)
    packs = LM.token_packs(many, "k", F.split("text", " "), 1000).collect()
    assert sorted((p.words, len(p.refs) // 12) for p in packs) == [(["x", "y", "z"], n) for n in (500, 1000, 1000)]
    assert len({p["_pack"] for p in packs}) == 3


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

PIECES = st.sampled_from(["a", "B", " ", "  ", "\t", '"', "@Foo_Bar", "#CamelTag", "#news", "RT @x:", "Trump", "Donald J. Trump",
                          "says Donald Trump", "via @realDonaldTrump", " - ", " -- ", " @ ", "w/", "w/over", ",", ".", "!",
                          "http://t.co/x", "BREAKING:", "FLASHBACK –", "—", "9pm"])


def letters(text):
    return "".join(c.lower() for c in text if c.isalnum())


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(PIECES, max_size=10).map(" ".join), min_size=1, max_size=30))
def test_no_new_words(spark, texts):
    """What comes out was there before, but for the words of the literal table."""
    for text, out in zip(texts, norm(spark, texts), strict=True):
        for word in out.split():
            assert letters(word) in letters(text) or letters(word) in ("me", "my", "at", "with", "withover"), (text, out)


@settings(max_examples=20, deadline=None)
@given(st.lists(st.lists(PIECES, max_size=10).map("".join), min_size=1, max_size=30))
def test_guards_are_exact(spark, texts):
    from tidewrack.functions import rules as R
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k long, raw_text string")
    guarded = [r.clean_text for r in R.apply_rules(df, "raw_text").orderBy("k").collect()]
    saved = R.GUARDS
    try:
        R.GUARDS = {}
        plain = [r.clean_text for r in R.apply_rules(df, "raw_text").orderBy("k").collect()]
    finally:
        R.GUARDS = saved
    assert guarded == plain


def test_invariant_report(spark):
    from tidewrack.functions import rules as R
    rows = [("a b", "a b"), ("@CamelName says", "Camel Name says my"), ("a", "a fact"), ("x", "fact x fact New"), (None, "all new"), ("a", None), ("naïve Ünder", "ünder NAÏVE")]
    df = spark.createDataFrame(rows, "s string, o string").select(R.new_words("s", "o").alias("w"))
    assert [r.w for r in df.collect()] == [[], [], ["fact"], ["fact", "new"], ["all", "new"], [], []]
