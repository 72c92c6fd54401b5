"""What a Python worker keeps between tasks goes when another operator, which keeps nothing, has its turn."""

from folio.llm import common


def test_a_task_that_keeps_nothing_lets_go(monkeypatch):
    monkeypatch.setattr(common, "_resident", {})
    asked = common.times_asked()
    common.resident("model", lambda: "m")
    common.let_go(asked)  # the task that asked for it
    assert common._resident == {"model": "m"}
    common.let_go(common.times_asked())  # a task that did not
    assert common._resident == {}


def test_across_tasks_of_a_session(spark):
    def keeps(slices):
        for c in slices:
            common.resident("model", lambda: "m")
            yield {"x": c["x"]}

    def looks(slices):
        for c in slices:
            yield {"x": [len(common._resident)] * len(c["x"])}

    one = spark.createDataFrame([(1,)], "x long").coalesce(1)
    common.map_rows(one, keeps, "x long").collect()
    common.map_rows(one, lambda s: ({"x": c["x"]} for c in s), "x long").collect()
    assert common.map_rows(one, looks, "x long").first()[0] == 0
