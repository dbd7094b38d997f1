"""tributary: Bronze, Silver and Gold processing of retail orders as plain Spark jobs.

Raw nested JSON lands in Bronze, becomes flat, clean, typed and de-duplicated
rows in Silver, and is mapped, aggregated and reported on in Gold. Every
operator is a function from DataFrame to DataFrame; Catalyst and adaptive
execution choose the physical plan.
"""
