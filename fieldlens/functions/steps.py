"""Column functions as short steps.

A function that mentions its argument several times multiplies the expression tree when calls are nested;
the generated code then outgrows what the JVM compiles. As a sequence of steps, each of which is one
``Project`` over the result of the one before, the same work stays in small compiled methods.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Step = Callable[[Column], Column]


def compose(steps: list[Step]) -> Step:
    """The steps as one expression, for lambdas, plain columns and small uses.

    Each step reads the result of the one before through the variable of a transform over a one-element array. The expression so grows by the
    sum of its steps; put into each other as they are, steps that mention their argument four times would multiply it."""
    def apply(c: Column) -> Column:
        one = F.array(c)
        for step in steps:
            one = F.transform(one, step)
        return F.get(one, F.lit(0))
    return apply


def in_steps(df: DataFrame, work: dict[str, tuple[Column, list[Step]]]) -> DataFrame:
    """Add columns computed step by step: name -> (source, steps). Steps of all columns run side by side."""
    if not work:
        return df
    df = df.withColumns({name: steps[0](source) for name, (source, steps) in work.items()})
    for i in range(1, max(len(steps) for _, steps in work.values())):
        df = df.withColumns({name: steps[i](F.col(f"`{name}`")) for name, (_, steps) in work.items() if i < len(steps)})
    return df


def spread(df: DataFrame, keep: list, array: Column | str, field: str) -> DataFrame:
    """One row per struct of an array column; ``field`` is a struct field that is never null.

    The plain generator lets the optimiser derive a filter on the array and push it down, which copies the
    whole expression into every step below; the outer form with a filter on its output does not.
    """
    return df.select(*keep, F.inline_outer(array)).filter(F.col(field).isNotNull())
