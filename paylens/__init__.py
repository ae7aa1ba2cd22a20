"""paylens: public-payroll analytics as Spark DataFrame transformations.

The public surface, by task:

* reading and writing: ``sources.readers`` / ``sources.sinks``;
  jobs ``ingest_bulk_csv``, ``consolidate_senate``, ``consolidate_chamber``,
  ``read_chamber_expenses``; incremental ``ingest_new_files``;
* explorer: ``search``, ``last_record``, ``last_records``, ``profiles``,
  ``select_profile``, ``kpis``, ``histogram``, ``top_pay``, ``display_table``,
  ``expense_breakdown``, ``expense_share``, ``build_catalogue``;
* audits: ``multi_employment``, ``pay_ranking``, ``surname_concentration``,
  ``pay_outliers``;
* expressions: ``clean_money``, ``digits_money``, ``format_clp``,
  ``fold_text``, ``unaccent_lower``, ``person_key``, ``month_name``,
  ``month_number``.
"""

from paylens.functions.money import clean_money, digits_money, digits_money_or_zero, format_clp
from paylens.functions.months import month_name, month_number
from paylens.functions.text import audit_full_name, fold_text, person_key, unaccent_lower
from paylens.operators.audits import (multi_employment, pay_outliers, pay_ranking,
                                      surname_concentration)
from paylens.operators.catalogue import available_years, build_catalogue, catalogue_job, organizations
from paylens.operators.expenses import (expense_breakdown, expense_share, footprint,
                                        pay_with_expenses)
from paylens.operators.joins import checked_broadcast, folded_link, spread_folded_link
from paylens.operators.legislative import (chamber_job, consolidate_chamber, consolidate_chamber_frames,
                                           consolidate_senate, senate_job,
                                           ingest_bulk_csv, read_chamber_expenses)
from paylens.operators.pages import heading, links, table_rows
from paylens.operators.search import (last_record, last_records, profiles, search,
                                      search_or_last_record, select_profile)
from paylens.operators.summary import display_table, histogram, kpis, top_pay
from paylens.operators.sync import coverage_gaps, manifest_diff
from paylens.operators.unify import audit_view, pay_rows, unify
from paylens.streaming.file_ingest import ingest_new_drops, ingest_new_files

__all__ = [n for n in dir() if not n.startswith("_")]
