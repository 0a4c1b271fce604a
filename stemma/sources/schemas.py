"""Schemas of the inputs and tables, as Spark DDL."""

from __future__ import annotations

#: Fixed value: the key of the bibliography among a paper's outside ids.
BIBLIOGRAPHY_KEY = "DBLP"

AUTHOR = "struct<authorId:string,name:string>"
#: One line of the bulk paper dump; both spellings of the keys occur.
BULK_PAPER = (
    "corpusid bigint, corpusId bigint, paperid string, paperId string, url string, title string, abstract string, venue string, year string, "
    f"citationcount string, citationCount string, referencecount string, referenceCount string, influentialcitationcount string, influentialCitationCount string, "
    f"authors array<{AUTHOR}>, externalids map<string,string>, externalIds map<string,string>, fieldsofstudy array<string>, fieldsOfStudy array<string>, "
    "s2fieldsofstudy string, publicationtypes array<string>, isopenaccess string, isOpenAccess string, openaccesspdf string, openAccessPdf string"
)
BULK_AUTHOR = (
    "authorid string, name string, aliases array<string>, affiliations array<string>, homepage string, papercount string, citationcount string, "
    "hindex string, externalids map<string,string>, url string"
)
BIBLIOGRAPHY = "key string, title string, authors array<string>, first_author string, year string, venue string, pages string, ee string, booktitle string, doi string"
ALL_PAPERS = (
    "corpus_id bigint, paper_id string, title string, title_key string, abstract string, venue string, venue_normalized string, year int, "
    f"citation_count int, reference_count int, influential_citation_count int, authors array<{AUTHOR}>, external_ids map<string,string>, "
    "fields_of_study array<string>, publication_types array<string>, is_open_access boolean, open_access_pdf string, source_file string"
)
AUTHORSHIPS = (
    "paper_id bigint, author_name string, matched_name string, matched_id string, match_order int, byline_position int, match_confidence string, match_method string"
)
RELEASES = "release_id string, dataset string, status string, processed bigint, created_at timestamp_ntz"
RUNS = "run_type string, run_time timestamp_ntz, status string, processed bigint, error string, seconds double"
