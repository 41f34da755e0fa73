"""Raw lines, and frames as rows or plans."""

from visitmill.schema import RAW_FIELDS

TIME = "Wed Jan 10 11:05:09 CST 2024"


def raw_line(**fields):
    """A valid raw line, with some fields changed."""
    values = {name: name[:3] for name in RAW_FIELDS}
    values.update(deviceNum="d1", customerId="c1", sessionId="s1", clientTime=TIME,
                  serverTime=TIME, currentUrl="http://a/1", previousUrl="http://a/0", memo="m")
    assert set(fields) <= set(values)
    values.update(fields)
    return "\t".join(values[name] for name in RAW_FIELDS)


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def plan(frame):
    return frame._jdf.queryExecution().explainString(
        frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
