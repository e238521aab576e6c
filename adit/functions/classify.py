"""Ordered first-match classification as plain column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from adit.functions import vocabulary as V
from adit.functions.text import once


def classify(c: Column, classes, default: Column | str | None = None, folded: bool = False) -> Column:
    """Label of the first (word, label) pair whose word occurs in the text, ignoring case.

    `folded` says that the text is in lower case already.
    """

    def label_of(text: Column) -> Column:
        chain = None
        for word, label in classes:
            hit = text.contains(word.lower())
            chain = F.when(hit, label) if chain is None else chain.when(hit, label)
        return chain.otherwise(default if isinstance(default, Column) else F.lit(default))

    return label_of(c) if folded else once(F.lower(c), label_of)


def classify_groups(c: Column, groups) -> Column:
    """As `classify`, with several words per label."""
    return classify(c, [(word, label) for label, words in groups for word in words])


def first_word(c: Column, words, folded: bool = False) -> Column:
    """The first word of the list (in list order) that occurs in the text."""
    return classify(c, [(w, w) for w in words], folded=folded)


def equipment_class(name: Column) -> Column:
    return classify(name, V.EQUIPMENT_CLASSES, "оборудование")


def premise_class(stated: Column) -> Column:
    return classify(stated, V.PREMISE_CLASSES, stated)


def premise_class_of_name(name: Column) -> Column:
    return classify(name, V.PREMISE_NAME_CLASSES, "выработка")


def damage_class(text: Column) -> Column:
    return classify(text, V.DAMAGE_CLASSES, "повреждения")


def sensor_class(stated: Column) -> Column:
    return classify(stated, V.SENSOR_CLASSES, stated)


def telemetry_class(parameter: Column, sensor_id: Column) -> Column:
    """The stated parameter decides; only without one does the id prefix (M, OY, C) count."""
    param, ident = F.upper(F.coalesce(parameter, F.lit(""))), F.upper(F.coalesce(sensor_id, F.lit("")))
    return (
        F.when(param.contains("CH4"), "CH4")
        .when(param.contains("CO"), "CO")
        .when(param.contains("SPEED"), "SPEED")
        .when(param != "", param)
        .when(ident.contains("CH4") | ident.startswith("M"), "CH4")
        .when(ident.contains("CO") | ident.startswith("OY"), "CO")
        .when(ident.startswith("C"), "SPEED")
        .otherwise("unknown")
    )


def unit_of(sensor_type: Column) -> Column:
    units = F.create_map(*[F.lit(x) for pair in V.SENSOR_UNITS.items() for x in pair])
    return F.try_element_at(units, sensor_type)


def shift_class(c: Column) -> Column:
    """`3`, `третья`, `3-я` -> `3-я`; an empty text is null, anything else stays as written."""
    stems = ("перв", "втор", "трет", "четв")
    words = [w for i, stem in enumerate(stems, 1) for w in ((str(i), f"{i}-я"), (stem, f"{i}-я"))]
    text = F.nullif(c, F.lit(""))
    return classify(text, words, text)


def yes_no(c: Column, default: int | None = None) -> Column:
    folded = F.lower(F.trim(c))
    return F.when(folded.isin(*V.YES_WORDS), 1).when(folded.isin(*V.NO_WORDS), 0).otherwise(F.lit(default))


def position_of(c: Column) -> Column:
    return F.coalesce(first_word(c, V.POSITIONS), F.trim(c))
