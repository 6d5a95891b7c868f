import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from factorlab.functions.parsing import accepted_examples, parse_examples
from factorlab.functions.vectors import dot
from factorlab.operators import metrics, mlp

LINES = ["([0.5, 1.0], [2.0, 1.0], 3.0)", "([[0.5], [1.0]], [[2.0], [1.0]], 3.0)",
         "([0.5], [2.0, 1.0], 3.0)", "([a, 1.0], [2.0, 1.0], 3.0)", ""]


def test_parse_training_lines(spark):
    lines = spark.createDataFrame([(x,) for x in LINES], "value string")
    parsed = parse_examples(lines)
    assert parsed.where("accepted").count() == 2
    assert parsed.where("NOT accepted").count() == 3
    ok = accepted_examples(parsed)
    rows = ok.collect()
    assert all(list(r.user_vec) == [0.5, 1.0] and list(r.item_vec) == [2.0, 1.0] and r.label == 3.0 for r in rows)
    mae = metrics.mae(ok.select("label", dot("user_vec", "item_vec").alias("p")), "label", "p").first()[0]
    assert mae == 1.0


def test_mlp_beats_median(spark):
    rng = np.random.default_rng(0)
    X = rng.random((3000, 4))
    y = 3 * X[:, 0] - 2 * X[:, 1] + X[:, 2] * X[:, 3]
    df = spark.createDataFrame(pd.DataFrame({"features": list(X), "label": y}))
    net = mlp.fit_mlp(df, epochs=15, batch=64, num_partitions=2, hidden=(32, 32))
    pred = mlp.predict_mlp(net, df)
    m = pred.agg(F.avg(F.abs(F.col("label") - F.col("prediction")))).first()[0]
    assert m < np.abs(y - np.median(y)).mean() * 0.5


def test_a_line_is_parsed_once(spark):
    lines = spark.createDataFrame([(x,) for x in LINES], "value string").repartition(1)
    plan = accepted_examples(parse_examples(lines, width=4))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") == 1


def test_the_width_is_that_of_most_numeric_lines(spark):
    two, three = "([1.0], [2.0], 3.0)", "([1.0, 2.0], [2.0], 3.0)"
    for lines, good in (([two, three, three], 2), ([two, three, "a, b, c, d", "a, b, c, d"], 1), (["a, b", "c, d", two], 1),
                        (["a, b"], 0), (["", "7"], 1), ([two] * 3 + ["a, b, c, d"] * 2, 3)):
        df = spark.createDataFrame([(x,) for x in lines], "value string")
        assert parse_examples(df).where("accepted").count() == good


def test_gradients_are_single_and_weights_double(monkeypatch):
    import pyarrow as pa

    rng = np.random.default_rng(2)
    X, real, kinds = rng.random((900, 3)), mlp._grad, set()
    y = X @ rng.random(3)
    batches = [pa.RecordBatch.from_arrays([pa.array(X[s:s + 400].tolist()), pa.array(y[s:s + 400])], names=["features", "label"])
               for s in (0, 400, 800)]
    model = mlp.init_mlp(3, (8, 4), 1)

    def weights(grad):
        monkeypatch.setattr(mlp, "_grad", grad)
        row = next(mlp._train_fn(model, 100, 1e-2, 0.9, 0.999, 1e-7, "features", "label")(iter(batches)))
        return row.column("total")[0].values.to_numpy() / row.column("n")[0].as_py()

    single = weights(lambda *a: kinds.add((a[1].dtype, a[2].dtype, a[3].dtype, (g := real(*a)).dtype)) or g)
    double = weights(lambda m, w, a, b: real(m, w.astype(float), a.astype(float), b.astype(float)))
    assert kinds == {(np.dtype("float32"),) * 4} and single.dtype == np.float64
    assert 0 < np.abs(single - double).max() < 1e-3
