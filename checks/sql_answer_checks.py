"""The seven answer functions called as SQL, with the oracles of their DataFrame forms."""

from __future__ import annotations

from checks.document_checks import corpus_model, questions
from checks.registry import ORACLES, check
from tallyloom.plans.sql_answers import register_answers, store_answer_index
from tallyloom.session import park, scratch_path

# Index folders by application and tables, written once.
_stored: dict[tuple[str, str], str] = {}


def _register(spark, sf) -> None:
    key = (spark.sparkContext.applicationId, sf)
    if key not in _stored:
        held, model = corpus_model(spark, sf)
        folder = scratch_path(spark, "answer-index")
        store_answer_index(park(held, "answer-vectors"), model, folder)
        _stored[key] = folder
    register_answers(spark, _stored[key])


def _sql_check(key: str, same_as: str, columns: str, call: str) -> None:
    @check(key)
    def _(spark, sf):
        _register(spark, sf)
        asked = questions(spark, sf).drop("qvec")
        return spark.sql(f"SELECT {columns}, {call} AS result FROM {{asked}}", asked=asked)

    ORACLES[key] = ORACLES[same_as]


_PRODUCT = "query_id, product_keyword"
_sql_check("x9_sql_get_warranty", "x1_get_warranty", _PRODUCT, "rag_get_warranty_raw(product_keyword)")
_sql_check("x9_sql_get_tech_specs", "x2_get_tech_specs", _PRODUCT, "rag_get_tech_specs_raw(product_keyword)")
_sql_check("x9_sql_get_certifications", "x3_get_certifications", _PRODUCT, "rag_get_certifications_raw(product_keyword)")
_sql_check("x9_sql_get_product_policy", "x4_get_product_profile", _PRODUCT, "rag_get_product_policy_raw(product_keyword)")
_sql_check("x9_sql_search_product_docs", "x5_search_docs", "query_id", "rag_search_product_docs_raw(query_text)")
_sql_check("x9_sql_search_by_doc_type", "x6_search_by_doc_type", "query_id", "rag_search_by_doc_type_raw(query_text, doc_type)")
_sql_check("x9_sql_get_discount", "x7_get_discount", "query_id", "rag_get_discount_by_category_raw(category_name, region_name)")
