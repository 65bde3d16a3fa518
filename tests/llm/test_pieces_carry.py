from pyspark.sql import functions as F

from tallystar.llm import op07_gumbel_pieces as op7


def test_text_goes_to_the_tasks_once(spark):
    docs = spark.createDataFrame([(1, "one two", 5), (2, None, 6), (3, "", 7)], "doc_id long, text string, x int")
    whole = op7.encode(docs, check="same")
    bare = op7.encode(docs, check="same", carry=["doc_id"])
    other = op7.encode(docs.select("doc_id", "x", F.struct("text").alias("row")), text="row.text", check="same", carry=["doc_id"])
    assert whole.columns == ["doc_id", "text", "x", "samples", "same"] and bare.columns == ["doc_id", "samples", "same"]
    rows = whole.orderBy("doc_id").collect()
    assert [(r.text, r.x, r.same) for r in rows] == [("one two", 5, True), (None, 6, None), ("", 7, True)]
    want = [(r.doc_id, r.samples, r.same) for r in rows]
    assert [tuple(r) for r in bare.orderBy("doc_id").collect()] == want
    assert [tuple(r) for r in other.orderBy("doc_id").collect()] == want

    def sent(df):
        plan = df._jdf.queryExecution().optimizedPlan()
        return [plan.child().output().apply(i).dataType().simpleString() for i in range(plan.child().output().size())]

    assert sent(whole).count("string") == 1 and sent(bare).count("string") == 1
