"""DataFrame-to-DataFrame operators: normalise, dedupe, report, search, features, exports."""
