"""JSON parsing that happens once per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parsed_once(text: Column | str, schema: str) -> Column:
    """``from_json`` behind a one-element generator.

    Spark pushes a filter on parsed fields below the projection that parses, and
    then repeats ``from_json`` for every field a rule mentions. A generator is
    not crossed by such filters, so each row is parsed exactly once.
    """
    return F.explode(F.array(F.from_json(text, schema)))
