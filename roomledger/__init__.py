"""roomledger: booking analytics on Spark DataFrames (staging, marts, data-quality rules, features,
walk-forward scoring, evaluation and a decision-rule backtest)."""
