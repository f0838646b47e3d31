"""DataFrame -> DataFrame operators.

NULL in a key column, one rule for all of them:

* What merges into a table (``upsert``, ``merge_changed_only``, ``scd1_apply``,
  ``scd2_apply_snapshot``, ``new_keys``, ``apply_changes`` of both types) rejects such
  source rows: they match nothing, and would pile up.  Quarantine them before.
* A history of a log (``scd2_history``) takes NULL as one more key, as GROUP BY
  does, and its incremental forms (``scd2_apply``, ``scd2_apply_fast``,
  ``scd2_append_latest``, the SCD2 store) meet NULL keys null-safely, so that both
  forms give the same rows.
* A lookup (``as_of_join``) is a join by equality: a fact with a NULL key finds no version.
"""
