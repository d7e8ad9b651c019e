import re

import __spark_entry__ as entry_mod

SURVEY_QUERIES = """conn_scan scan_limit split_manifest label_not_null label_benign_flag label_binary
benign_subset feature_projection class_counts imbalance_severity class_weight feature_medians
feature_moments category_vocab impute_median impute_constant standardize one_hot ablate_numeric
ablate_categorical seq_windows_full seq_windows_padded restore_order union_all stratified_sample
ratio_split shuffled_split chronological_split split_leakage_audit candidate_gbt candidate_rf
candidate_mlp_seq batch_scores candidate_scorecards ablation_report packet_filter packet_normalize
flow_key flow_initiator flow_history flow_aggregate flow_service flow_state flow_by_window
window_throughput batch_means live_sequences live_alerts live_scorecard warmup_fill label_by_source
whitelist_override alert_record threshold_decision score_pair confusion_matrix scorecard_basic
scorecard_error_rates roc_auc pr_auc pr_curve_points scorecard_full model_select metric_delta
scorecard_pivot udf_scores turn_flow_history turn_flow_aggregate""".split()
ROWS_ONLY = {"batch_scores", "candidate_gbt", "candidate_rf", "candidate_mlp_seq",
             "candidate_scorecards", "ablation_report", "ablation_report_tree", "three_way_scorecard"}


def test_registry_covers_survey():
    q, o = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(SURVEY_QUERIES) <= set(q)
    assert set(o) <= set(q)
    own = {k for k in q if not re.match(r"op\d+_|pipeline$", k)}   # the others have tests of their own
    assert own - set(o) <= ROWS_ONLY


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and "history" in df.columns
