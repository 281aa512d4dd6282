"""Vocabularies and thresholds.

Fixed values: stage names, ranks, groups, tiers and limits of the data product.
"""

STAGES = ["official", "done", "agreed", "medical", "personal_terms", "negotiating", "interest", "rumour", "collapsed", "other"]
DISPLAYABLE = STAGES[:9]
STAGE_GROUP = {"agreed": "agreed", "medical": "agreed", "negotiating": "talks", "personal_terms": "talks"}
LEAD_RANK = {"official": 6, "done": 5, "agreed": 4, "medical": 3, "personal_terms": 2, "negotiating": 1, "collapsed": 1}
DIRECTIONS = ["in", "out", "none"]
TIERS = [0.0, 1.0, 1.5, 2.0, 3.0, 4.0]
TOP_TIERS = [0.0, 1.0, 1.5]
TOP_HORIZON_DAYS = 10
STATUSES = ["in_link", "out_link", "in_done", "out_done", "loan_in", "loan_out", "link_dropped", "other_club"]
COMPLETED = ["in_done", "out_done", "loan_in", "loan_out"]
EARLY = ["rumour", "interest", "negotiating", "personal_terms"]
ADVANCED = ["agreed", "medical", "official"]
CLOSING = ["done", "collapsed"]
RETENTION, NGRAM = 0.75, 8
REALERT_HOURS, STALE_HOURS = 48.0, 48.0
SIGMA, MIN_BASELINE = 2, 3
WINDOW_MINUTES, LEAST_OVERLAP = 360, 4
TRACKING = ("utm_", "fbclid", "gclid")
