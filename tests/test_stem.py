import random

from bandlex.functions.stem import add_stem
from porter import stem

# from the worked examples of the published algorithm
GOLDEN = """caresses:caress ponies:poni ties:ti caress:caress cats:cat feed:feed agreed:agre disabled:disabl matting:mat
mating:mate meeting:meet milling:mill messing:mess meetings:meet plastered:plaster bled:bled motoring:motor sing:sing
conflated:conflat troubled:troubl sized:size hopping:hop tanned:tan falling:fall hissing:hiss fizzed:fizz failing:fail
filing:file happy:happi sky:sky relational:relat conditional:condit rational:ration digitizer:digit
vietnamization:vietnam predication:predic operator:oper feudalism:feudal decisiveness:decis hopefulness:hope
callousness:callous triplicate:triplic formative:form formalize:formal electrical:electr hopeful:hope goodness:good
revival:reviv allowance:allow inference:infer airliner:airlin gyroscopic:gyroscop adjustable:adjust defensible:defens
irritant:irrit replacement:replac adjustment:adjust dependent:depend adoption:adopt communism:commun activate:activ
homologous:homolog effective:effect bowdlerize:bowdler probate:probat rate:rate cease:ceas controll:control roll:roll
booking:book conception:concept conceptions:concept reinvigorating:reinvigor reinvigorated:reinvigor smells:smell
fingers:finger has:ha as:as is:is"""


def stems(spark, words):
    rows = add_stem(spark.createDataFrame([(w,) for w in words], "token string")).collect()
    return {row.token: row.term for row in rows}


def test_published_examples(spark):
    expected = dict(pair.split(":") for pair in GOLDEN.split())
    assert stems(spark, expected) == expected


def test_random_words_and_runs_of_y(spark):
    rng = random.Random(7)
    ends = "s es ies ed eed ing y ational ation izer bli logi icate ness ement ion sion e ll alize ative ivity".split()
    words = {"y" * n for n in range(1, 30)} | {c + "y" * n + e for c in "ab" for n in range(20) for e in ("", "ing", "ed", "s")}
    for _ in range(4000):
        body = "".join(rng.choice("aeiouybcdlstvwxz") for _ in range(rng.randint(0, 7)))
        words.add(body + rng.choice(ends))
    words.discard("")
    found = stems(spark, sorted(words))
    assert {w: t for w, t in found.items() if t != stem(w)} == {}


def test_words_of_the_given_documents(spark):
    from bandlex.operators.tokens import stem_vocabulary

    rows = stem_vocabulary(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")).collect()
    assert len(rows) > 1000
    assert [r for r in rows if r.term != stem(r.token)] == []


def test_filter_on_stem_is_not_moved_into_the_steps(spark):
    df = add_stem(spark.createDataFrame([("cats",), ("dogs",)], "token string")).where("term = 'cat'")
    assert [row.token for row in df.collect()] == ["cats"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Filter") < plan.index("Generate")


def test_no_step_is_taken_for_words_without_its_endings(spark):
    """Each step, and the lookup of letters, is behind the test of the ending."""
    words = ["walk", "tax", "graph", "zoo", "yak", "syz", "be", "ss", "sky", "walks", "ally", "ion", "motion"]
    assert stems(spark, words) == {w: stem(w) for w in words}
    table = spark.createDataFrame([(w,) for w in words], "token string")
    plan = add_stem(table)._jdf.queryExecution().optimizedPlan().toString()
    assert "__open" in plan and "translate(" not in plan
