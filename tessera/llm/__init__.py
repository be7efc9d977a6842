"""Training-data operators: language ID, LM scoring, toxicity, HTML text, URL
filters, near and exact de-duplication, BPE, mixing, conversation repair, hard
negatives and nearest neighbours. Nothing else in the library imports this
package."""
