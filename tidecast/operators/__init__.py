"""DataFrame operators: cleaning, series, calendar, forecasts, scoring, weekly and weather frames."""
