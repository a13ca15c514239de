"""All registered queries: name -> (Spark query, SQL on the base tables or None)."""

from lexweave.plans.audit_queries import QUERIES as AUDIT
from lexweave.plans.page_queries import QUERIES as PAGES
from lexweave.plans.rule_queries import QUERIES as RULES
from lexweave.plans.structure_queries import QUERIES as STRUCTURE
from lexweave.plans.text_queries import QUERIES as TEXT

CATALOGUE = {**STRUCTURE, **TEXT, **PAGES, **AUDIT, **RULES}
