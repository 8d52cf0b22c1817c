"""quernflow: a Spark-first engine for semi-structured defect reports, feature pools and coverage feedback."""
