"""Booking analytics on Spark: star-schema build, booking KPIs, demand series, churn labels and classifiers."""
