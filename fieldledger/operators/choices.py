"""Choice questions: labels for codes, and one column per choice."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from fieldledger.functions.text import clean_names
from fieldledger.operators.columns import quoted, unused
from fieldledger.session import kept

_PAIRS = "array<struct<question:string,element:string>>"


def list_columns(df: DataFrame) -> list[str]:
    """Names of the columns that hold lists of text."""
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StringType)
    ]


def explode_list(df: DataFrame, column: str, alias: str = "element") -> DataFrame:
    """One row per non-null list element, other columns kept."""
    others = [quoted(c) for c in df.columns if c != column]
    return df.select(*others, F.explode(quoted(column)).alias(alias)).where(F.col(alias).isNotNull())


def list_elements(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct elements of each list column: ``question``, ``element``; one scan for all columns."""
    names = list(columns) if columns is not None else list_columns(df)

    def pairs_of(name: str):
        return F.transform(
            quoted(name), lambda e: F.struct(F.lit(name).alias("question"), e.alias("element"))
        )

    pairs = [pairs_of(name) for name in names]
    empty = F.array().cast(_PAIRS)
    both = F.concat(*[F.coalesce(p.cast(_PAIRS), empty) for p in pairs]) if pairs else empty
    return df.select(F.inline(both)).where(F.col("element").isNotNull()).distinct()


def one_hot(df: DataFrame, columns: Sequence[str] | None = None, elements: DataFrame | None = None) -> DataFrame:
    """Replace list columns by one 0/1 column per distinct element, named ``<column>_<element>``.

    Elements whose cleaned names are equal share a column. They become schema, so the driver learns them: from the data in
    one more pass, or from ``elements`` (``question``, ``element``), such as the choices of a form, without reading any
    row. Then all of them get a column, and elements that the table lacks are kept in ``<column>_others``, a map
    as that of ``choice_maps``. Where elements are too many for columns, use that form for all of them.
    """
    names = list(columns) if columns is not None else list_columns(df)
    found = list_elements(df, names) if elements is None else elements.where(F.col("question").isin(names))
    given = found.where(F.col("element").isNotNull()).select("question", "element").distinct()
    rows = sorted(tuple(r) for r in given.collect()) if names else []
    members: dict[str, list] = {}
    for (question, element), name in zip(rows, clean_names([e for _, e in rows]), strict=True):
        has = F.array_contains(quoted(question), element)
        members.setdefault(f"{question}_{name}", []).append(F.coalesce(has, F.lit(False)).cast("tinyint"))
    others = [quoted(c) for c in df.columns if c not in set(names)]
    hot = [(F.greatest(*cols) if len(cols) > 1 else cols[0]).alias(name) for name, cols in members.items()]
    if elements is not None:
        for name in names:
            known = F.array(*[F.lit(e) for q, e in rows if q == name]).cast("array<string>")
            hot.append(_as_map(F.array_except(quoted(name), known)).alias(f"{name}_others"))
    return df.select(*others, *hot)


def _as_map(elements: Column) -> Column:
    """Map of each distinct element to 1; null has none."""
    given = F.array_distinct(F.filter(F.coalesce(elements, F.array().cast("array<string>")), lambda e: e.isNotNull()))
    return F.map_from_arrays(given, F.transform(given, lambda e: F.lit(1).cast("tinyint")))


def choice_maps(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Replace list columns by maps of element to 1: the sparse form of ``one_hot``.

    It needs no schema, hence no look at the data, however many distinct elements there are.
    """
    names = set(columns if columns is not None else list_columns(df))
    return df.select(*[_as_map(quoted(c)).alias(c) if c in names else quoted(c) for c in df.columns])


# Choices that go into the projection as a lookup; a larger table is joined.
LITERAL_CHOICES = 10_000


def _codes(answer: Column) -> Column:
    """The codes of a multi-select answer."""
    return F.filter(F.split(answer.cast("string"), " "), lambda c: c != "")


def replace_labels(
    df: DataFrame, choices: DataFrame, multiple: Sequence[str] = (), literal_choices: int = LITERAL_CHOICES
) -> DataFrame:
    """Choice codes as labels; ``choices`` has ``question``, ``code``, ``label``.

    A multi-select answer is a text of codes parted by spaces and becomes a list of labels, in their order. Codes
    without a label stay; of several labels of a code the greatest counts. The choices of a form are mostly few: up to
    ``literal_choices`` are a lookup in the projection, without a join. More of them are joined, question by question.
    """
    wanted = choices.where(F.col("question").isin(list(df.columns)) & F.col("code").isNotNull() & F.col("label").isNotNull())
    labels = wanted.groupBy("question", "code").agg(F.max("label").alias("label"))
    rows = labels.limit(literal_choices + 1).collect()
    if len(rows) > literal_choices:
        return _join_labels(df, kept(labels, "labels"), multiple)
    lookups: dict[str, dict[str, str]] = {}
    for row in rows:
        lookups.setdefault(row.question, {})[row.code] = row.label

    def labelled(name: str):
        lookup = lookups.get(name)
        table = F.create_map(*[F.lit(x) for pair in sorted(lookup.items()) for x in pair]) if lookup else None

        def one(code):
            return F.coalesce(F.try_element_at(table, code), code) if lookup else code

        if name in set(multiple):
            return F.transform(_codes(quoted(name)), one).alias(name)
        return one(quoted(name).cast("string")).alias(name) if lookup else quoted(name)

    return df.select(*[labelled(name) for name in df.columns])


def _join_labels(df: DataFrame, labels: DataFrame, multiple: Sequence[str]) -> DataFrame:
    """Labels by joins: a left join per question that has some.

    The labels of a list depend on the text of the answer alone, so each distinct answer is taken apart once, joined by
    code, put together in the order of its codes, and joined back by its text. Lookups are written first: Spark
    knows their size, broadcasts small ones, and can split an answer that very many rows give.
    """
    names = df.columns
    asked = {r.question for r in labels.select("question").distinct().collect()}  # at most the columns of df
    key, found = unused(names, "_key"), unused(names, "_found")
    for name in names:
        if name not in asked and name not in set(multiple):
            continue
        text = quoted(name).cast("string")
        own = labels.where(F.col("question") == name).select(F.col("code").alias("_code"), F.col("label").alias("_label"))
        if name not in asked:
            value = _codes(text)
        elif name in set(multiple):
            lists = kept(_list_labels(df.select(text.alias("_answer")), own), "answers")
            df = df.join(lists.toDF(key, found), text == F.col(key), "left")
            value = F.coalesce(found, F.when(text.isNotNull(), F.array().cast("array<string>")))
        else:
            df = df.join(own.toDF(key, found), text == F.col(key), "left")
            value = F.coalesce(found, text)
        df = df.select(*[value.alias(c) if c == name else quoted(c) for c in names])
    return df


def _list_labels(answers: DataFrame, labels: DataFrame) -> DataFrame:
    """Each distinct answer (``_answer``) with the labels of its codes, ``_labels``."""
    codes = answers.distinct().select("_answer", F.posexplode(_codes(F.col("_answer"))).alias("_at", "_own"))
    named = codes.join(labels, codes["_own"] == labels["_code"], "left")
    label = F.struct("_at", F.coalesce("_label", "_own").alias("_text"))
    ordered = F.array_sort(F.collect_list(label))
    return named.groupBy("_answer").agg(F.transform(ordered, lambda x: x["_text"]).alias("_labels"))
