"""Explicit schemas: the article row, the inputs, and the output tables."""

from __future__ import annotations

# One citation. Leaves stay strings; the flatteners turn years and the like into ints.
AFFILIATION = (
    "struct<affiliation:string, institution_name:string, country_code:string, country_name:string>"
)
AUTHOR = (
    "struct<valid_yn:string, last_name:string, fore_name:string, initials:string, suffix:string, "
    "identifier_source:string, identifier:string, "
    f"affiliations:array<{AFFILIATION}>>"
)
JOURNAL = (
    "struct<title:string, iso_abbreviation:string, volume:string, issue:string, "
    "pub_year:string, pub_month:string, pub_day:string>"
)
PUB_DATE = "struct<pub_status:string, year:string, month:string, day:string>"
HEADING = (
    "struct<descriptor_name:string, descriptor_major_topic_yn:string, descriptor_ui:string, "
    "qualifiers:array<struct<name:string, major_topic_yn:string, ui:string>>>"
)
REFERENCE = "struct<citation:string, article_ids:array<struct<id_type:string, value:string>>>"
DATABANKS = (
    "struct<complete_yn:string, "
    "banks:array<struct<name:string, accession_numbers:array<string>>>>"
)
KEYWORD = "struct<keyword:string, major_topic_yn:string>"

ARTICLE = (
    "doc_id string, source_file string, pmid string, title string, "
    f"journal {JOURNAL}, authors array<{AUTHOR}>, pub_dates array<{PUB_DATE}>, "
    f"headings array<{HEADING}>, references array<{REFERENCE}>, "
    f"databanks {DATABANKS}, keywords array<{KEYWORD}>"
)

# The citation element as the XML parser reads it: `_x` is an attribute, `_VALUE` the text.
_TEXT = "struct<_VALUE:string>"
_RAW_ID = "struct<_VALUE:string, _Source:string>"
_RAW_NAME = "struct<_VALUE:string, _MajorTopicYN:string, _UI:string>"
_RAW_AUTHOR = (
    "struct<_ValidYN:string, LastName:string, ForeName:string, Initials:string, Suffix:string, "
    f"Identifier:array<{_RAW_ID}>, AffiliationInfo:array<struct<Affiliation:string>>>"
)
_RAW_JOURNAL = (
    "struct<Title:string, ISOAbbreviation:string, JournalIssue:struct<Volume:string, Issue:string, "
    "PubDate:struct<Year:string, Month:string, Day:string>>>"
)
_RAW_BANK = (
    "struct<DataBankName:string, AccessionNumberList:struct<AccessionNumber:array<string>>>"
)
_RAW_REFERENCE = (
    "struct<Citation:string, ArticleIdList:struct<ArticleId:"
    "array<struct<_VALUE:string, _IdType:string>>>>"
)
CORRUPT = "_malformed"
RAW_ARTICLE = (
    "MedlineCitation struct<"
    f"PMID:{_TEXT}, "
    "Article:struct<ArticleTitle:string, "
    f"Journal:{_RAW_JOURNAL}, "
    f"AuthorList:struct<Author:array<{_RAW_AUTHOR}>>, "
    f"DataBankList:struct<_CompleteYN:string, DataBank:array<{_RAW_BANK}>>>, "
    "MeshHeadingList:struct<MeshHeading:array<struct<"
    f"DescriptorName:{_RAW_NAME}, QualifierName:array<{_RAW_NAME}>>>>, "
    "KeywordList:array<struct<Keyword:array<struct<_VALUE:string, _MajorTopicYN:string>>>>>, "
    "PubmedData struct<"
    "History:struct<PubMedPubDate:array<struct<"
    "_PubStatus:string, Year:string, Month:string, Day:string>>>, "
    f"ReferenceList:array<struct<Reference:array<{_RAW_REFERENCE}>>>>, "
    f"{CORRUPT} string"
)

# The same citation as a JSON tree: the groups stay variants, since a group is an
# array only when it repeats.
_LEAF = "struct<value:string>"
TREE = (
    "struct<MedlineCitation:struct<"
    f"PMID:{_LEAF}, "
    f"Article:struct<ArticleTitle:{_LEAF}, "
    f"Journal:struct<Title:{_LEAF}, ISOAbbreviation:{_LEAF}, "
    f"JournalIssue:struct<Volume:{_LEAF}, Issue:{_LEAF}, "
    f"PubDate:struct<Year:{_LEAF}, Month:{_LEAF}, Day:{_LEAF}>>>, "
    "AuthorList:struct<Author:variant>, "
    "DataBankList:struct<CompleteYN:string, DataBank:variant>>, "
    "MeshHeadingList:struct<MeshHeading:variant>, KeywordList:variant>, "
    "PubmedData:struct<History:struct<PubMedPubDate:variant>, ReferenceList:variant>>"
)
TREE_AUTHOR = (
    f"struct<ValidYN:string, LastName:{_LEAF}, ForeName:{_LEAF}, Initials:{_LEAF}, "
    f"Suffix:{_LEAF}, Identifier:variant, AffiliationInfo:variant>"
)
TREE_IDENTIFIER = "struct<Source:string, value:string>"
TREE_AFFILIATION = (
    f"struct<Affiliation:{_LEAF}, institution_name:string, country_code:string, "
    "country_name:string>"
)
TREE_DATE = f"struct<PubStatus:string, Year:{_LEAF}, Month:{_LEAF}, Day:{_LEAF}>"
TREE_NAME = "struct<value:string, MajorTopicYN:string, UI:string>"
TREE_HEADING = f"struct<DescriptorName:{TREE_NAME}, QualifierName:variant>"
TREE_REFERENCE = f"struct<Citation:{_LEAF}, ArticleIdList:struct<ArticleId:variant>>"
TREE_ARTICLE_ID = "struct<IdType:string, value:string>"
TREE_BANK = f"struct<DataBankName:{_LEAF}, AccessionNumberList:struct<AccessionNumber:variant>>"
TREE_LEAF = _LEAF

# One vocabulary record.
RAW_DESCRIPTOR = (
    "DescriptorUI string, DescriptorName struct<String:string>, "
    "TreeNumberList struct<TreeNumber:array<string>>, "
    f"{CORRUPT} string"
)

# One registry entry, as far as the dictionaries need it.
REGISTRY = "name string, country struct<country_code:string, country_name:string>"

# Output table names, columns and their order. The spelling
# `qualifer_major_topic_yn` is the one existing readers of the table use.
TABLE_COLUMNS = {
    "pub_pmid_list": "pmid int",
    "pub_pubdate": "pmid int, year int, month int, day int",
    "pub_article_title": "pmid int, article_title string",
    "pub_author": (
        "pmid int, author_no bigint, valid_yn string, lastname string, forename string, "
        "collectivename string, initials string, suffix string, identifier_source string, "
        "identifier string"
    ),
    "pub_affiliation": (
        "pmid int, affiliation_no bigint, affiliation string, affiliation_country string, "
        "affiliation_organization string, affiliation_identifier_source string, "
        "affiliation_identifier string"
    ),
    "pub_author_affiliation": "pmid int, author_no bigint, affiliation_no bigint",
    "pub_databank_list": (
        "pmid int, databank_list_complete_yn string, databank_name string, "
        "accession_number string"
    ),
    "pub_journal": (
        "pmid int, title string, iso_abbreviation string, volume string, issue string, "
        "pub_year int, pub_month string, pub_day int"
    ),
    "pub_keyword_list": (
        "keyword_index bigint, pmid int, keyword string, keyword_major_topic_yn string"
    ),
    "pub_reference": (
        "pmid int, ref_no bigint, citation string, ref_article_id_pubmed string, "
        "ref_article_id_doi string, ref_article_id_pmcid string, ref_article_id_pii string"
    ),
    "pub_mesh_heading": (
        "pmid int, descriptor_index bigint, descriptor_name string, "
        "descriptor_major_topic_yn string, descriptor_type string, descriptor_ui string, "
        "qualifier_name string, qualifer_major_topic_yn string, qualifier_ui string"
    ),
    "pub_mesh_desc_list": "descriptor_ui string, descriptor_name string",
    "pub_mesh_trees": "descriptor_ui string, mesh_tree string, mesh_category string",
}

# Rows that could not be used, and why.
QUARANTINE = "source string, doc_id string, stage string, reason string"
