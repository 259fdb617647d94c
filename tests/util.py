"""Helpers of the tests: plain rows, plans, and DuckDB over the same rows."""

import decimal
import random

import duckdb


def rows(df):
    return [tuple(row) for row in df.collect()]


def sorted_rows(table):
    return sorted(table, key=lambda row: tuple((value is None, str(value)) for value in row))


def plain(row):
    """Decimals as floats, so that both engines' fixed-point types compare."""
    return tuple(
        round(float(value), 6) if isinstance(value, (decimal.Decimal, float)) else value
        for value in row
    )


def same_rows(df, relation):
    ours = sorted_rows(map(plain, rows(df)))
    theirs = sorted_rows(map(plain, relation))
    assert ours == theirs


def physical_plan(df):
    """The plan before execution."""
    return df._jdf.queryExecution().executedPlan().toString()


def executed_plan(df):
    """The plan that adaptive execution ended up with. Runs the query."""
    query = df._jdf.queryExecution()
    query.toRdd().count()
    return query.executedPlan().toString()


class Frames:
    """The same random rows as Spark frames and as DuckDB tables."""

    def __init__(self, spark, seed):
        self.spark, self.random, self.duck = spark, random.Random(seed), duckdb.connect()
        self.frames = {}

    def add(self, name, ddl, table):
        """``ddl`` is read by both engines; ``table`` is a list of tuples."""
        self.frames[name] = self.spark.createDataFrame(table, ddl)
        self.duck.execute(f"CREATE TABLE {name} ({ddl.replace('STRING', 'VARCHAR')})")
        marks = ", ".join("?" * len(self.frames[name].columns))
        if table:
            self.duck.executemany(f"INSERT INTO {name} VALUES ({marks})", table)

    def draw(self, count, *makers):
        return [tuple(make() for make in makers) for _ in range(count)]

    def whole(self, low, high, nulls=0.0):
        def make():
            return None if self.random.random() < nulls else self.random.randint(low, high)

        return make

    def hot(self, low, high, hot, share=0.4):
        """Whole numbers of which a large share is one value."""
        return lambda: hot if self.random.random() < share else self.random.randint(low, high)

    def pick(self, *values):
        return lambda: self.random.choice(values)

    def sql(self, text):
        return self.duck.execute(text).fetchall()
