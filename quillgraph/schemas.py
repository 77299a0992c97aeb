"""Schemas of the raw records and of the stored tables, as DDL; parsed when asked for, since parsing needs a session."""

from __future__ import annotations

from functools import cache

from pyspark.sql import types as T


_SOURCE = "struct<id:string,display_name:string,type:string,issn_l:string,issn:array<string>,host_organization:string,is_oa:boolean>"
_INSTITUTION = "struct<id:string,display_name:string,country_code:string>"

#: One work as it comes. The year is text, so that numbers, quoted numbers and junk all parse.
_RAW_WORK = (
    "id string, publication_year string, publication_date string, title string, abstract_inverted_index map<string,array<int>>, "
    "cited_by_count int, referenced_works_count int, fwci double, type string, is_retracted boolean, is_paratext boolean, language string, doi string, "
    "ids map<string,string>, open_access struct<is_oa:boolean,oa_url:string>, "
    f"primary_location struct<landing_page_url:string,pdf_url:string,source:{_SOURCE}>, referenced_works array<string>, "
    f"authorships array<struct<author:struct<id:string>,author_position:string,is_corresponding:boolean,institutions:array<{_INSTITUTION}>>>, "
    "concepts array<struct<id:string,display_name:string,level:int,score:double>>, created_date string, updated_date string"
)
_RAW_AUTHOR = "id string, display_name string, works_count int, cited_by_count int, summary_stats struct<h_index:int>"

TABLES: dict[str, str] = {
    "works": (
        "work_id string, publication_year int, publication_date string, title string, abstract_text string, title_length int, abstract_length int, "
        "cited_by_count int, referenced_works_count int, fwci double, source_id string, work_type string, is_retracted boolean, is_paratext boolean, "
        "language string, doi string, ids string, is_open_access boolean, open_access_url string, landing_page_url string, pdf_url string, "
        "created_date string, updated_date string"
    ),
    "citation_edges": "cited_work_id string, citing_work_id string",
    "authorships": "work_id string, author_id string, author_position string, author_sequence int, is_corresponding boolean",
    "affiliations": "work_id string, author_id string, institution_id string",
    "institutions": "institution_id string, institution_name string, country string",
    "sources": "source_id string, source_name string, source_type string, linking_issn string, issn_list string, host_organization_id string, is_oa boolean",
    "concepts": "concept_id string, concept_name string, concept_level int",
    "scores": "work_id string, concept_id string, concept_score double",
    "selected_scores": "work_id string, concept_id string, concept_score double",
    "authors": "author_id string, author_name string, first_publication_year int, last_publication_year int, works_count int, cited_by_count int, h_index int",
}


@cache
def parsed(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def raw_work() -> T.StructType:
    return parsed(_RAW_WORK)


def raw_author() -> T.StructType:
    return parsed(_RAW_AUTHOR)


def stored(table: str, *more: str) -> T.StructType:
    """The schema as it is written: the table's columns, those of more, and snapshot_date."""
    return parsed(", ".join([TABLES[table], *more, "snapshot_date string"]))
