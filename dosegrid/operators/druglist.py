"""Selection and validation of drug lists."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dosegrid.functions.columns import strip

#: Aliases of development phases.
PHASES = {"PR": "Preclinical", "P2": "Phase 2", "AP": "Approved", "P3": "Phase 3", "P1": "Phase 1", "E1": "Early Phase 1"}
#: Codes of natural-product pathways and the class texts they stand for.
PATHWAYS = {
    "a": "Shikimates and Phenylpropanoids",
    "b": "Polyketides",
    "c": "Terpenoids",
    "d": "Amino acids and Peptides",
    "e": "Carbohydrates",
    "f": "Alkaloids",
    "g": "Fatty acids",
    "ab": "Polyketides, Shikimates and Phenylpropanoids",
    "ac": "Shikimates and Phenylpropanoids, Terpenoids",
    "ad": "Amino acids and Peptides, Shikimates and Phenylpropanoids",
    "ae": "Carbohydrates, Shikimates and Phenylpropanoids",
    "af": "Alkaloids, Shikimates and Phenylpropanoids",
    "ag": "Fatty acids, Shikimates and Phenylpropanoids",
    "bc": "Polyketides, Terpenoids",
    "bd": "Amino acids and Peptides, Polyketides",
    "be": "Carbohydrates, Polyketides",
    "bf": "Alkaloids, Polyketides",
    "bg": "Fatty acids, Polyketides",
    "cd": "Amino acids and Peptides, Terpenoids",
    "ce": "Carbohydrates, Terpenoids",
    "cf": "Alkaloids, Terpenoids",
    "cg": "Fatty acids, Terpenoids",
    "de": "Amino acids and Peptides, Carbohydrates",
    "df": "Alkaloids, Amino acids and Peptides",
    "dg": "Amino acids and Peptides, Fatty acids",
    "ef": "Alkaloids, Carbohydrates",
    "eg": "Carbohydrates, Fatty acids",
    "fg": "Alkaloids, Fatty acids",
    "abc": "Polyketides, Shikimates and Phenylpropanoids, Terpenoids",
    "bcf": "Alkaloids, Polyketides, Terpenoids",
    "bcg": "Fatty acids, Polyketides, Terpenoids",
    "bdf": "Alkaloids, Amino acids and Peptides, Polyketides",
    "bdg": "Amino acids and Peptides, Fatty acids, Polyketides",
    "cdf": "Alkaloids, Amino acids and Peptides, Terpenoids",
    "adfg": "Alkaloids, Amino acids and Peptides, Fatty acids",
    "adf": "Alkaloids, Amino acids and Peptides, Shikimates and Phenylpropanoids",
    "acd": "Amino acids and Peptides, Shikimates and Phenylpropanoids, Terpenoids",
    "ade": "Amino acids and Peptides, Carbohydrates, Shikimates and Phenylpropanoids",
}
#: Drug names of a threshold table and the names they stand for.
NAME_CORRECTIONS = {
    "VX-680": "Tozasertib", "Mitomycin C": "Mitomycin-C", "HG-6-64-1": "HG6-64-1", "BAY 61-3606": "BAY-61-3606", "Zibotentan, ZD4054": "Zibotentan", "PXD101, Belinostat": "Belinostat",
    "NU-7441": "NU7441", "BIRB 0796": "BIRB-796", "Nutlin-3a": "Nutlin-3a (-)", "AZD6482.1": "AZD6482", "BMS-708163.1": "BMS-708163", "BMS-536924.1": "BMS-536924", "GSK269962A.1": "GSK269962A",
    "SB-505124": "SB505124", "JQ1.1": "JQ1", "UNC0638.1": "UNC0638", "CHIR-99021.1": "CHIR-99021", "piperlongumine": "Piperlongumine", "PLX4720 (rescreen)": "PLX4720",
    "Afatinib (rescreen)": "Afatinib", "Olaparib.1": "Olaparib", "AZD6244.1": "AZD6244", "Bicalutamide.1": "Bicalutamide", "RDEA119 (rescreen)": "RDEA119", "GDC0941 (rescreen)": "GDC0941", "MLN4924 ": "MLN4924",
}


def usable(smiles: Column) -> Column:
    return smiles.isNotNull() & (F.length(strip(smiles)) > 0) & ~F.coalesce(smiles.startswith("Error"), F.lit(False))


def reject_reason(name: Column, smiles: Column) -> Column:
    """Null for a usable drug."""
    return (
        F.when(name.isNull() | (F.length(strip(name)) == 0), "no name")
        .when(smiles.isNull(), "no smiles")
        .when(F.length(strip(smiles)) == 0, "blank smiles")
        .when(smiles.startswith("Error"), "failed lookup")
    )


def _containing(column: Column, phrases: Sequence[str]) -> Column:
    return reduce(lambda x, y: x | y, (F.coalesce(column.contains(p), F.lit(False)) for p in phrases))


def by_class(df: DataFrame, column: str, aliases: Sequence[str], phrases: dict[str, str] = PHASES) -> DataFrame:
    """Rows whose class contains any of the aliases' phrases. Aliases are of either case; ALL: any phrase; unknown ones are skipped, and none left is an error. Containment: 'Phase 1' finds 'Early Phase 1' too."""
    upper = [a.strip().upper() for a in aliases]
    wanted = list(phrases.values()) if upper == ["ALL"] else [phrases[a] for a in upper if a in phrases]
    if not wanted:
        raise ValueError(f"no known class among {list(aliases)}")
    return df.where(_containing(F.col(column), wanted))


def pathway_phrase(code: str) -> str | None:
    """The class text of a code, whose letters may be in any order and case; None for 'all'; an unknown code stands for itself."""
    key = "".join(sorted(code.lower()))
    return None if key == "all" else PATHWAYS.get(key, code)


def by_pathway(df: DataFrame, column: str, codes: Sequence[str]) -> DataFrame:
    """Rows whose class contains the text of any of the codes; with 'all' among them, rows with a class. No codes are an error."""
    wanted = [pathway_phrase(c) for c in codes if c]
    if not wanted:
        raise ValueError("no pathway codes")
    return df.where(F.col(column).isNotNull() if None in wanted else _containing(F.col(column), wanted))


def distinct_drugs(df: DataFrame, name: str, smiles: str, limit: int | None = None) -> DataFrame:
    found = df.select(F.col(name).alias("drug_name"), F.regexp_replace(smiles, "\r$", "").alias("smiles")).distinct()
    return found.orderBy("drug_name", "smiles").limit(limit) if limit is not None else found


def first_id(c: Column) -> Column:
    """First of a comma list; null for 'none' and 'several'."""
    return F.when(c.isNotNull() & ~c.isin("none", "several"), F.get(F.split(c, ","), F.lit(0)))
